"""Reading file trees, the content table, and writing files back out."""
