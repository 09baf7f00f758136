"""Event-code helpers: root-code normalisation, labels, conflict sets."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the published taxonomy) -------------------------
# CAMEO root code -> label, codes "01".."20" in natural order.
ROOT_LABELS: dict[str, str] = {
    "01": "Make Public Statement",
    "02": "Appeal",
    "03": "Express Intent to Cooperate",
    "04": "Consult",
    "05": "Engage in Diplomatic Cooperation",
    "06": "Engage in Material Cooperation",
    "07": "Provide Aid",
    "08": "Yield",
    "09": "Investigate",
    "10": "Demand",
    "11": "Disapprove",
    "12": "Reject",
    "13": "Threaten",
    "14": "Protest",
    "15": "Exhibit Military Posture",
    "16": "Reduce Relations",
    "17": "Coerce",
    "18": "Assault",
    "19": "Fight",
    "20": "Use Unconventional Mass Violence",
}
UNKNOWN_LABEL = "Unknown"
# Conflict root codes of the default risk score and of the "weighted10" variant.
CONFLICT_CODES = ("14", "15", "16", "17", "18", "19", "20")
CONFLICT_CODES_WEIGHTED10 = ("18", "19", "20")
# --- end fixed values ----------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_root_code(c: Column | str) -> Column:
    """Trim, then left-pad with zeros to width 2 without ever truncating.

    Mirrors a string ``zfill(2)``: a sign stays in front of the padding, longer
    codes are kept whole, null stays null.
    """
    t = F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")  # strip all whitespace
    return (
        F.when(F.length(t) >= 2, t)
        .when(t.isin("+", "-"), F.concat(t, F.lit("0")))  # zfill pads after a sign
        .otherwise(F.lpad(t, 2, "0"))
    )


def lpad_root_code(c: Column | str) -> Column:
    """SQL ``LPAD(CAST(c AS STRING), 2, '0')``: pads short codes, truncates long ones."""
    return F.lpad(_c(c).cast("string"), 2, "0")


def root_label(c: Column | str) -> Column:
    """Label of a normalised root code; codes outside the taxonomy get "Unknown".

    A literal map expression: evaluated inside whole-stage codegen, no join.
    """
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(ROOT_LABELS.items())])
    return F.coalesce(F.element_at(m, _c(c)), F.lit(UNKNOWN_LABEL))
