"""DataFrame operators.

search    exact top-k (IP / L2 / COSINE), one or many queries, filters, per-query days
ivf       clustered cells (IVF_FLAT, IVF_SQ8 via quantize), probes, re-rank, index layout
quantize  per-dimension 8-bit codes
bm25      postings, BM25 ranking, drop-ratio pruning, term match
tables    collections: lifecycle, appends, day expiry, counts, compaction, dispatching search
backfill  capacity-limited backfill by day (closed form) and ingest progress
filters   range / prefix / term predicates that run before scoring
evaluate  ground truth, recall, exact percentiles, latency, capacity
merge     deep merge of nested JSON documents by key
"""
