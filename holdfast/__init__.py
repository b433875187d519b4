"""holdfast: subscriber-retention analytics expressed as Spark plans."""
