"""Column builders: field verdicts, month arithmetic, run stamps."""
