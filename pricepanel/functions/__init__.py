"""Part of pricepanel."""
