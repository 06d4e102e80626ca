"""Gap imputation operators. Contract: input (station, time, value) on a dense grid; output the
same rows plus the completed column. Positional methods use the row position (equal spacing)."""
