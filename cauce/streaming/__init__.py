"""Landing of files as they arrive; all other operators are batch work on landed tables."""
