"""Writers: partitioned tables, snapshots and JDBC."""
