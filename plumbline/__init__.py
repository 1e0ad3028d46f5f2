"""plumbline: audited analytical tables from messy public-sector records, as Spark plans."""
