"""Fill-in-the-middle scorecards on Spark."""
