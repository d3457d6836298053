"""pixelloom: near-duplicate image curation and training-data operators as Spark plans."""
