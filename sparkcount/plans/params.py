"""Parameters of the registered queries.

Both the Spark plans and the oracle SQL read them from here, so the two
sides always carry the same literals.
"""

from __future__ import annotations

from sparkcount.functions.hashing import Affine, EdgeBucket
from sparkcount.operators.sketch import PolySketchParams, SketchParams

# Graph: colours, one colour hash, five runs, the edge-bucket hash.
C = 4
H1 = Affine(4321, 777)
RUNS = [Affine(1000 + 37 * i, 11 * i) for i in range(1, 6)]
BUCKET = EdgeBucket(4321, 777, 5)

# Text: salt groups.
K_SALT = 4

# Stream: interval, sketch, top-K, stop rule.
LEFT, RIGHT = 1, 300
K_TOP = 10
SKETCH = SketchParams.draw(D=5, W=30, seed=7)
THRESHOLD = 6000
# sketch from the 4-wise independent family, of the same size
SKETCH4 = PolySketchParams.draw(D=5, W=30, seed=7)
# hours since 1970 of an interval whose sketch is the difference of two others
HOUR_FROM, HOUR_TO = 473_452, 473_752
# arrival files hold 60 hours each: 13 micro-batches; the state's partitions
ARRIVAL_HOURS = 60
STATE_PARTITIONS = 4
# event time for which the distinct items of a stream are remembered
DISTINCT_DELAY = "80 hours"
# intervals for the skewed (floor(value / 25)) and flat (user_id) items
LEFT_SKEWED, RIGHT_SKEWED = 0, 15
LEFT_FLAT, RIGHT_FLAT = 1, 1000

# Accuracy sweep, shaped like the recorded one: W at K=30, K at W=100, and
# the interval's right end at W=30, K=10 (ends that cut the items, which go to
# about 500); D=9, three repeats of each setting
# (each repeat draws its own hashes).
SWEEP_D = 9
SWEEP_SEED = 100
SWEEP_GRID = (
    [{"W": w, "K": 30, "left": 1, "right": 10000, "rep": r}
     for w in (15, 20, 50, 100) for r in (1, 2, 3)]
    + [{"W": 100, "K": k, "left": 1, "right": 10000, "rep": r}
       for k in (10, 50, 100, 200) for r in (1, 2, 3)]
    + [{"W": 30, "K": 10, "left": 1, "right": right, "rep": r}
       for right in (60, 120, 240, 480) for r in (1, 2, 3)]
)
