"""Ready-made plans: corpora derived from tables, and the catalogue of queries over them."""
