"""Credit-risk data mart: snapshot ingest, cleaning, labels, feature store, training and scoring."""
