"""All registered queries and oracles."""

from basketflow.plans.batch import BATCH_QUERIES
from basketflow.plans.ml import ML_QUERIES
from basketflow.plans.oracles import BATCH_ORACLES, ML_ORACLES, STREAM_ORACLES
from basketflow.plans.streams import STREAM_QUERIES

QUERIES = {}
QUERIES.update(BATCH_QUERIES)
QUERIES.update(STREAM_QUERIES)
QUERIES.update(ML_QUERIES)

ORACLES = {}
ORACLES.update(BATCH_ORACLES)
ORACLES.update(STREAM_ORACLES)
ORACLES.update(ML_ORACLES)
