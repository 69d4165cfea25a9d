"""Jobs: whole computations over named tables, for all requested sets at once."""
