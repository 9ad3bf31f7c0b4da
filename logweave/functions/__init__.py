"""Column expressions: named log formats, one-pass regex groups, md5 buckets and
time-zone-free wall-clock helpers."""
