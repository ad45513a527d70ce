"""Sources: file listing and format detection, archive expansion, split planning,
byte-range record reading and record parsing."""
