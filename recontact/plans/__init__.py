"""Campaign selections. Each takes a warehouse and an as-of date and returns rows without writing."""
