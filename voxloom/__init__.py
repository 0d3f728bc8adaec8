"""A Spark-native engine that turns recorded or transcribed speech into training samples."""
