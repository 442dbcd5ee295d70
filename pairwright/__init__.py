"""Match one table of records to another, then label the matches, as Spark jobs."""
