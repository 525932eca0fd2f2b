"""quire: Spark-native operators over large corpora of books, pages, logs and source files."""
