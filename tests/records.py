"""Scoring records made from the contract itself: every field at an allowed value."""

from tessera import config as C

FIELDS = (*C.CONTRACT_RANGES, *C.CONTRACT_REQUIRED_FLAGS, *C.CONTRACT_DEFAULTED_FLAGS)


def record(**changes):
    """Numbers at their lower bound, flags 0, one flag of each one-hot family 1; then the changes."""
    out = {name: low for name, (low, _) in C.CONTRACT_RANGES.items()}
    out |= dict.fromkeys(C.CONTRACT_REQUIRED_FLAGS + C.CONTRACT_DEFAULTED_FLAGS, 0)
    for family in ("internet_service_", "contract_type_", "payment_method_"):
        out[max(f for f in C.CONTRACT_DEFAULTED_FLAGS if f.startswith(family))] = 1
    return out | changes


def frame(spark, records, text=False):
    """(rid, fields...) rows, rid counting from 0; all fields as text if asked."""
    kind = {f: "string" if text else "double" if "charge" in f else "int" for f in FIELDS}
    rows = [(f"rec{i}", *((None if r[f] is None else str(r[f])) if text else r[f] for f in FIELDS)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "rid string, " + ", ".join(f"{f} {t}" for f, t in kind.items()))
