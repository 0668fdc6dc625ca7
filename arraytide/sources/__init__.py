"""Readers and table maintenance: logger files, observatory archive, survey tables, run ledger."""
