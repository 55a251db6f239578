"""tallyforge: listing normalisation and table-quality operators as plain Spark DataFrame functions."""
