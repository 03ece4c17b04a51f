"""Where tables come from and where results are written."""
