"""Reading and writing: lake, reports, profiles, graph files, catalog and Kafka."""
