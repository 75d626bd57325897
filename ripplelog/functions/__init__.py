"""Types, value normalisation and DDL text: the functions that rows pass through."""
