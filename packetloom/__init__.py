"""Transfer-monitoring analytics for Spark: packets in, analysis-ready tables out."""
