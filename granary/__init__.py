"""granary: dataset curation as Spark plans."""
