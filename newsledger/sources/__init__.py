"""Reading pages, link profiles and the stored tables."""
