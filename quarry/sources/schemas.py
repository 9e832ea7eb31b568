"""Explicit schemas of the logical inputs (no schema inference anywhere).

CSV inputs are declared as strings where the raw file may hold junk and are
converted with ``try_cast`` by :func:`quarry.sources.readers.cast_columns`,
so a bad value becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

ACCESS_LOG = T.StructType([T.StructField("value", T.StringType())])

CLAIM_NUMERIC = ["ClaimNb", "Exposure", "VehPower", "VehAge", "DrivAge",
                 "BonusMalus", "Density"]
CLAIM_CATEGORICAL = ["Area", "VehBrand", "VehGas", "Region"]
POLICY_CLAIMS = T.StructType(
    [T.StructField("IDpol", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLAIM_NUMERIC + CLAIM_CATEGORICAL])

MOVIES = T.StructType([
    T.StructField("movieId", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

# Column names of the 29-column collision-event file, in order.
COLLISION_COLUMNS = [
    "label", "lepton pT", "lepton eta", "lepton phi", "missing energy magnitude",
    "missing energy phi", "jet 1 pt", "jet 1 eta", "jet 1 phi", "jet 1 b-tag",
    "jet 2 pt", "jet 2 eta", "jet 2 phi", "jet 2 b-tag", "jet 3 pt", "jet 3 eta",
    "jet 3 phi", "jet 3 b-tag", "jet 4 pt", "jet 4 eta", "jet 4 phi", "jet 4 b-tag",
    "m_jj", "m_jjj", "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb",
]
COLLISION_EVENTS = T.StructType([T.StructField(f"_c{i}", T.StringType())
                                 for i in range(len(COLLISION_COLUMNS))])
