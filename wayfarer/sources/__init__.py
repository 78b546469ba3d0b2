"""Input relations: survey fixtures derived from the star tables, zone polygons."""
