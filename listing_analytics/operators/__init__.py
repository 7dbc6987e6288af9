"""DataFrame operators: `fn(df, ...) -> DataFrame`, usable with `df.transform`."""
