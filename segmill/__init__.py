"""Member segmentation and script mining as DataFrame functions."""
