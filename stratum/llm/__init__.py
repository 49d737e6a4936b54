"""Operators of a training-data pipeline: quality scoring, line and near-duplicate
removal, nearest neighbours, exact top-k, WARC archives, packing, token files,
piece encoding and chat repair. Nothing outside this package imports it."""
