"""maskloom: de-identify and re-identify tables and streams of documents on Spark."""
