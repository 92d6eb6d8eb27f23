"""Writers: collection store, column logs, wrapped JSON rows, bulk import."""
