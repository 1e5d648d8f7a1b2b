"""Business-key and text helpers. All are Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions._util import as_col


def strip_key(c) -> Column:
    """SC-1: trim blanks, then strip leading zeros; an all-zero key gives ''."""
    return F.ltrim(F.trim(as_col(c)), F.lit("0"))


def strip_key_or_null(c) -> Column:
    """SC-2: ``strip_key`` with '' turned into NULL."""
    return F.nullif(strip_key(c), F.lit(""))


def strip_zeros(c) -> Column:
    """SC-3: strip leading zeros only; a leading blank stops the strip (S-5: keep SC-1/2/3 apart)."""
    return F.ltrim(as_col(c), F.lit("0"))


def pad_key(c, width: int) -> Column:
    """SC-4: left-pad with zeros to ``width`` (SQL lpad: longer input is cut)."""
    return F.lpad(F.trim(as_col(c).cast("string")), width, "0")


def py_pad_key(c, width: int) -> Column:
    """SC-4, Python ``rjust`` form: longer input is kept whole."""
    s = as_col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


# Fixed value: the ASCII whitespace that Python's ``str.strip()`` removes.
PY_WHITESPACE = " \t\n\r\x0b\x0c"


def py_strip(c) -> Column:
    """SC-16: Python ``str.strip()``: removes leading/trailing whitespace, not only blanks.

    A character-set trim (no regex), so it stays a cheap codegen expression.
    """
    return F.trim(as_col(c).cast("string"), F.lit(PY_WHITESPACE))


def blank_to_null(c) -> Column:
    """SC-8: trimmed text, NULL when empty."""
    return F.nullif(F.trim(as_col(c).cast("string")), F.lit(""))


def py_text(c) -> Column:
    """Python ``str(v).strip() or None`` of a value."""
    return F.nullif(py_strip(c), F.lit(""))


def as_text(c) -> Column:
    """SC-29: value as text, trimmed."""
    return F.trim(as_col(c).cast("string"))


def norm_code(c) -> Column:
    """SC-11: upper-case, trimmed code."""
    return F.upper(F.trim(as_col(c)))


def has_key(c) -> Column:
    """PF-12: normalised key is not empty (NULL keys fail)."""
    return F.coalesce(strip_key(c) != F.lit(""), F.lit(False))


def as_long(c) -> Column:
    """JN-7 / S-4: text key to bigint, bad text gives NULL instead of failing."""
    return F.trim(as_col(c).cast("string")).try_cast("bigint")


def int_text(c) -> Column:
    """SC-22: numeric text to canonical text: cast to int, NULL as 0, back to text."""
    return F.coalesce(F.trim(as_col(c).cast("string")).try_cast("bigint"), F.lit(0)).cast("string")


def concat_key(a, wa: int, b, wb: int) -> Column:
    """SC-7: two zero-padded parts; NULL if a part is NULL."""
    return F.concat(F.lpad(F.trim(as_col(a).cast("string")), wa, "0"),
                    F.lpad(F.trim(as_col(b).cast("string")), wb, "0"))


def doc_id(order, po, rc) -> Column:
    """SC-10: order number, else 'PC-' + PO, else 'RC-' + requisition."""
    pc = F.nullif(F.concat(F.lit("PC-"), strip_key(F.coalesce(as_col(po), F.lit("")))), F.lit("PC-"))
    return F.coalesce(strip_key_or_null(order), pc, F.concat(F.lit("RC-"), strip_key(rc)))


def key_variants(c) -> Column:
    """SC-5: raw (stripped of whitespace), zero-stripped, 12- and 18-padded forms.

    Returns an array without duplicates and without empty strings, in the
    order raw, stripped, 12-padded, 18-padded.
    """
    s = py_strip(c)
    sem = F.ltrim(s, F.lit("0"))
    items = F.array(
        s,
        F.when(sem != "", sem),
        F.when(sem != "", py_pad_key(sem, 12)),
        F.when(sem != "", py_pad_key(sem, 18)),
    )
    return F.array_distinct(F.filter(items, lambda x: x.isNotNull() & (x != "")))


def material_variants(c) -> Column:
    """SC-6: ``key_variants`` plus each variant right-padded with blanks to 40."""
    v = key_variants(c)
    padded = F.transform(v, lambda x: F.when(F.length(x) >= 40, x).otherwise(F.rpad(x, 40, " ")))
    return F.array_distinct(F.flatten(F.transform(
        F.arrays_zip(v.alias("a"), padded.alias("b")), lambda z: F.array(z["a"], z["b"]))))


def form_key(c) -> Column:
    """SC-5 read backwards: the key that a written form belongs to, so that forms meet by an equi-join.

    The stripped number for the stripped, the 12- and the 18-padded form of a number; any other text (zeros
    alone, or zeros up to another length) is a key of its own; NULL for an empty text. A key has these forms
    only, so two keys share none.
    """
    s = as_col(c)
    sem = F.ltrim(s, F.lit("0"))
    return F.when((sem != "") & ((sem == s) | F.length(s).isin(12, 18)), sem).otherwise(F.nullif(s, F.lit("")))


def form_keys(c) -> Column:
    """The ``form_key`` of all ``key_variants`` of a text: two if it is written with zeros to another length."""
    s = py_strip(c)
    keys = F.array(form_key(s), F.nullif(F.ltrim(s, F.lit("0")), F.lit("")))
    return F.array_distinct(F.filter(keys, lambda x: x.isNotNull()))


def material_form_key(c) -> Column:
    """SC-6: ``form_key`` of a written material number, which may be padded with blanks to 40 characters; with
    blanks up to another length it is no form."""
    s = as_col(c)
    bare = F.rtrim(s)
    return F.when((bare == s) | (F.length(s) == 40), form_key(bare))


def digits(c) -> Column:
    """SC-15: keep digits only."""
    return F.regexp_replace(as_col(c).cast("string"), r"[^0-9]", "")


def flag01(c, mark: str = "X") -> Column:
    """SC-28: 1 when the trimmed mark equals ``mark``, else 0."""
    return F.when(F.trim(F.coalesce(as_col(c), F.lit(""))) == mark, 1).otherwise(0)


def desc_text_key(c) -> Column:
    """A key whose ascending order is the descending (NULLs first) order of text ``c``.

    The UTF-8 bytes as hex digits, each digit complemented (0<->F ...), and a
    closing 'Z' above every digit, so that a longer text sorts before its
    own prefix. Lets ``min``/``min_by`` pick "latest by text" with a plain
    ascending struct key instead of a window.
    """
    col = as_col(c).cast("string")
    comp = F.translate(F.hex(F.encode(col, "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210")
    return F.struct(col.isNotNull().alias("present"), F.concat(comp, F.lit("Z")).alias("key"))


def require_keys(df, cols):
    """PF-19: drop rows where any of ``cols`` is blank after a Python-style strip."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (py_strip(F.coalesce(as_col(c).cast("string"), F.lit(""))) != "")
    return df.filter(cond)


def requisition_ref(own, generated) -> Column:
    """SC-23: the receipt's own requisition reference, else the generated PO
    number, else '' (``NULLIF`` only skips ''), leading zeros stripped (SC-3)."""
    return strip_zeros(F.coalesce(F.nullif(as_col(own), F.lit("")), as_col(generated), F.lit("")))


def label(lot, positions) -> Column:
    """SC-14: 'lot - positions', or only the positions when the lot is blank."""
    return F.when(F.nullif(as_col(lot), F.lit("")).isNull(), as_col(positions)).otherwise(
        F.concat(as_col(lot), F.lit(" - "), as_col(positions)))
