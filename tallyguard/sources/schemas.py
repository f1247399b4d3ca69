"""Schemas of the raw files and of the stored shapes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in spec])


_D, _L, _I, _S = T.DoubleType(), T.LongType(), T.IntegerType(), T.StringType()

CCF = _struct([("Time", _D), *[(f"V{i}", _D) for i in range(1, 29)], ("Amount", _D), ("Class", _I)])

PAYSIM = _struct([
    ("step", _L), ("type", _S), ("amount", _D), ("nameOrig", _S), ("oldbalanceOrg", _D),
    ("newbalanceOrig", _D), ("nameDest", _S), ("oldbalanceDest", _D), ("newbalanceDest", _D),
    ("isFraud", _I), ("isFlaggedFraud", _I)])

# the raw header repeats "Account"; names are given here so that the second is "Account.1"
IBM_AML = _struct([
    ("Timestamp", _S), ("From Bank", _L), ("Account", _S), ("To Bank", _L), ("Account.1", _S),
    ("Amount Received", _D), ("Receiving Currency", _S), ("Amount Paid", _D),
    ("Payment Currency", _S), ("Payment Format", _S), ("Is Laundering", _I)])

ELLIPTIC_FEATURES = _struct([("txId", _L), ("time_step", _I), *[(f"f{i}", _D) for i in range(1, 166)]])
ELLIPTIC_CLASSES = _struct([("txId", _L), ("class", _S)])

BANKSIM = _struct([
    ("step", _I), ("customer", _S), ("age", _S), ("gender", _S), ("zipcodeOri", _S),
    ("merchant", _S), ("zipMerchant", _S), ("category", _S), ("amount", _D), ("fraud", _I)])

METADATA = _struct([("dataset", _S), ("split", _S), ("label", _I), ("is_fraud", T.BooleanType())])
MESSAGES = T.ArrayType(_struct([("role", _S), ("content", _S)]))
CHAT = _struct([("messages", MESSAGES), ("metadata", METADATA)])
ALPACA = _struct([("instruction", _S), ("output", _S), ("metadata", METADATA)])
