"""Writers for the curated zone (SNK-1, SNK-3) and the raw zone (SNK-6)."""
