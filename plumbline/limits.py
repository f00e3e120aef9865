"""Size bounds that decide between a small-data plan and a fully distributed one.

Every bound guards a choice between two exact plans; none of them changes a result.
"""

# A lookup table with at most this many rows may be broadcast to every executor.
BROADCAST_ROWS = 100_000

# Above this many rows an exact median is found by histogram refinement instead of
# the built-in aggregate, whose buffer holds every distinct value.
MEDIAN_BUFFER_ROWS = 2_000_000

# Rows of one side of a distance block; a block pair is what one task holds.
BLOCK_ROWS = 4096

# Rows of one side of a silhouette tile, and numbers that its sums may hold.
TILE_ROWS = 65_536
TILE_CELLS = 8_000_000

# Leaf regions of the space partition used to prune block pairs.
MAX_REGIONS = 256

# Rows sampled to place region boundaries (boundaries never change results).
BOUNDARY_SAMPLE_ROWS = 20_000

# Active clusters below which the remaining Ward merges are finished in one task.
WARD_FINISH_ROWS = 8192

# Label columns whose distance sums are accumulated in one pass.
LABEL_COLUMNS_PER_PASS = 512

# Rows of one key prefix that are ranked by a window when a split looks for its cut key.
CELL_ROWS = 200_000

# Rows below which an iterative fit does not profit from another task.
ROWS_PER_TASK = 20_000
