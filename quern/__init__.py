"""quern: a Spark-native engine that classifies large catalogs of data files."""
