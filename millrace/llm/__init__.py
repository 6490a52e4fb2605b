"""Training-data operators on whole corpora. Nothing else in the package imports this one."""
