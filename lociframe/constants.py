"""Fixed values that define the semantics of the analysis."""

LOWEST_P, WORKER_MIN_P = 1.5e-4, 1e-6
H4_THRESHOLD, MIN_POSTERIOR = 0.8, 0.5
PAIR_DISTANCE, MIN_SHARED_SNPS = 50_000, 50
MIN_DEGREE_FRACTION = 0.05
EAF_COMMON = (0.005, 0.995)
EAF_RARE = (0.000012, 0.01)
LD_KEEP_R2, SAME_CAUSAL_R2 = 0.8, 0.99
CHUNK_ROWS = 5_000_000
COLOC_PRIORS = (1e-4, 1e-4, 1e-5)
IMPUTATION_LD_R = 0.6
SMALLEST_P = 2.2250738585072014e-308
Z_975 = 1.959963984540054
HEAVY_BLOCK_STUDIES = 10_000
EDGE_MIN_WEIGHT = 0.8
EDGE_LOGP = (4.0, 7.301)
