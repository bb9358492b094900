"""Jobs that write: bronze commit, silver load, incremental models, retention, guarded SQL."""
