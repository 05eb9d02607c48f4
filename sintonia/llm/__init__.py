"""Operators of a training-data pipeline, each over whole tables of documents or
pages.  Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when it is there."""
