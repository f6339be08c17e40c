"""Song-chart and lyric-text analytics as composable Spark DataFrame operators."""
