"""SQL fragments for the DuckDB oracle strings.

They spell the same computations as ``tessera.functions`` in DuckDB SQL
(RE2 regexes with the ``'g'`` flag, 1-based list slicing). Only strings are
built here.
"""

from __future__ import annotations

from tessera.functions import text as T


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_RUN = lit(T.WS_RUN)


def clean(e: str) -> str:
    return (f"nullif(trim(regexp_replace(regexp_replace({e}, {lit(T.HTML_TAG)}, ' ', 'g'), "
            f"{WS_RUN}, ' ', 'g')), '')")


def word_count(e: str) -> str:
    return f"len(list_filter(regexp_split_to_array({e}, {WS_RUN}), lambda x: x <> ''))"


def tokens(e: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({e}), {lit(T.WORD_SPLIT)}), "
            f"lambda x: regexp_full_match(x, '[a-z]{{2,}}'))")


def split_case(rank: str, n: str, fracs=(0.8, 0.1), names=("train", "val", "test")) -> str:
    parts, cut = [], "0"
    for name, f in zip(names[:-1], fracs):
        cut = f"{cut} + floor(CAST({f!r} AS DOUBLE) * {n})"
        parts.append(f"WHEN {rank} < {cut} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{names[-1]}' END"


def md5_order(id_expr: str, seed: int | str = 42) -> str:
    return f"md5(concat_ws(':', CAST({id_expr} AS VARCHAR), '{seed}'))"


def spec_block(name="name", brand="brand", category="category", sku="sku", material="material",
               finish="finish", size="size", length="length_cm", breadth="breadth_cm",
               height="height_cm", weight="weight_grams", mrp="mrp", tagline="short_description") -> str:
    def opt(label, c):
        return f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN '{label}: ' || {c} END"

    def num(c):
        return f"({c} IS NOT NULL AND {c} <> 0)"

    dims = ("concat_ws(' x ', "
            + ", ".join(f"CASE WHEN {num(c)} THEN '{p}=' || CAST({c} AS VARCHAR) || 'cm' END"
                        for p, c in (("L", length), ("B", breadth), ("H", height)))
            + ")")
    return ("concat_ws(chr(10), 'Name: ' || coalesce(" + name + ", ''), "
            + opt("Brand", brand) + ", " + opt("Category", category) + ", " + opt("SKU", sku) + ", "
            + opt("Material", material) + ", " + opt("Finish", finish) + ", " + opt("Size", size) + ", "
            + f"CASE WHEN {dims} <> '' THEN 'Dimensions: ' || {dims} END, "
            + f"CASE WHEN {num(weight)} THEN 'Weight: ' || printf('%.0f', round_even({weight}, 0)) || ' g' END, "
            + f"CASE WHEN {num(mrp)} THEN 'MRP: ₹' || printf('%.2f', {mrp}) END, "
            + opt("Tagline", tagline) + ")")
