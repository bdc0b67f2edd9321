"""Sources and sinks: the packed-series text format, the city reference, the code table, and the adapter that
derives series from the driver's TPC-H-style tables."""
