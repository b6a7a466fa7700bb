"""An extension: the pipeline over a folder that grows."""
