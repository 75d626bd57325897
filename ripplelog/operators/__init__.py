"""DataFrame operators on change logs, snapshots, offsets and layouts."""
