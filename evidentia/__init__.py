"""Evidence analytics on Spark: governed tables, facts, retrieval and audits as DataFrame plans."""
