"""Column-level functions: code cleaning, segmentation rules, text extraction."""
