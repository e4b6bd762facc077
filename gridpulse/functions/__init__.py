"""Signal kernels and their pandas UDFs."""
