"""Writers: files, SQL tables and bulk-insert payloads."""
