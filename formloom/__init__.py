"""Document analytics on Spark: text to lines, fields and reports, as DataFrame plans."""
