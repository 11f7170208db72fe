"""DataFrame operators: joins, intervals, regions, counting, calling."""
