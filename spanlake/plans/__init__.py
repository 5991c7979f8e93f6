"""Query descriptions (what is asked) and the choice of the table that answers them."""
