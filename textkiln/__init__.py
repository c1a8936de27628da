"""textkiln: building and auditing language-model training corpora on Spark."""
