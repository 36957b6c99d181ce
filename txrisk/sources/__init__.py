"""Where rows come from and go to: files, message envelopes, Kafka, JDBC, batch tables."""
