"""Reading and writing the files around the pipeline."""
