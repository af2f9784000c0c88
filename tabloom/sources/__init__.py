"""Reading tables and showing what they hold."""
