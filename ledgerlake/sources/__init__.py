"""Readers: delimited bank files, delta sessions, JDBC seed options, derived test tables, literal frames."""
