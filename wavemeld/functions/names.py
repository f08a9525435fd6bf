"""Column-name and label clean-up, as Spark expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def normalise(name: Column | str) -> Column:
    """Lower-case snake form: every run outside ``[a-z0-9]`` becomes one ``_``.

    Most names are in this form already, which is cheaper to see than to make.
    """
    c = F.col(name) if isinstance(name, str) else name
    made = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(c.rlike("[^a-z0-9]"), made).otherwise(c)


def normalise_text(name: str) -> str:
    """The same rule for one header or alias the driver already holds."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def safe_label(label: Column | str) -> Column:
    """A dataset label usable in a file name."""
    c = F.col(label) if isinstance(label, str) else label
    return F.regexp_replace(c, "[^A-Za-z0-9_-]", "_")


def safe_label_text(label: str) -> str:
    return re.sub(r"[^A-Za-z0-9_-]", "_", label)


def unique_header(names: list[str]) -> list[str]:
    """Number repeated names ``_1``, ``_2``, … and skip numbers already taken.

    For one file header; :func:`wavemeld.operators.catalogue.unique_names`
    is the same rule over a catalogue of many headers.
    """
    taken, seen, next_no, out = set(names), set(), {}, []
    for name in names:
        if name not in seen:
            seen.add(name)
            out.append(name)
            continue
        k = next_no.get(name, 1)
        while f"{name}_{k}" in taken:
            k += 1
        next_no[name] = k + 1
        out.append(f"{name}_{k}")
    return out
