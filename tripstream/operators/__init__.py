"""DataFrame-to-DataFrame operators. Those in `filters` and `tips` take tables and streams alike."""
