"""Readers and writers: lake scans, file drops, versioned tables, manifests, exports."""
