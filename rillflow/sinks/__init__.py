"""Writers: landing files, the date-partitioned lake, quarantine, counters, audit rows."""
