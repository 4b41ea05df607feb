"""Reading tables in, writing tables out."""
