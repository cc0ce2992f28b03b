"""Writers: files, interval partitions, snapshots, exports and JDBC."""
