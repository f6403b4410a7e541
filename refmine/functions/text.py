"""Text functions as pure Column expressions; nothing here leaves the JVM.

White space is Unicode white space (29 code points), letters and digits are the
categories L and N, unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WS = r"\s\x1c-\x1f\x{85}\p{Z}"

# Fixed values of the link and file-name rules.
DOI_URL = r"(?i)^https?://doi\.org/([^\n]+)"
DOI_ANYWHERE = rf"10\.\p{{Nd}}{{4,9}}/[^{WS}]+"
LINK_TAIL = ").,;"
COUNT_SUFFIX = rf"[{WS}]*\(\+\p{{Nd}}+\)$"
FILE_SUFFIXES = r"((\.jsonl|\.ndjson)(\.gz)?|\.gz)$"
CONTEXT_FILE_KINDS = {"citing": "citing_contexts", "cited": "cited_contexts", "both": "combined_contexts"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_u(c: Column | str) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(_col(c), f"^[{WS}]+|[{WS}]+$", "")


def collapse_ws(c: Column | str) -> Column:
    """Trimmed, every inner run of white space one blank."""
    return F.regexp_replace(trim_u(c), f"[{WS}]+", " ")


def is_blank(c: Column | str) -> Column:
    """True for text without any character but white space; null stays null."""
    return ~F.rlike(_col(c), F.lit(f"[^{WS}]"))


def not_blank(c: Column | str) -> Column:
    return F.coalesce(F.rlike(_col(c), F.lit(f"[^{WS}]")), F.lit(False))


def bare_form(c: Column | str) -> Column:
    """Letters and digits only, in lower case, accents kept."""
    return F.lower(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]+", ""))


def normalize_name(c: Column | str) -> Column:
    """Lower case, trimmed, punctuation deleted, white space runs one blank.

    There is no second trim: a blank that deleted punctuation leaves at an end stays.
    """
    lowered = trim_u(F.lower(_col(c)))
    return F.regexp_replace(F.regexp_replace(lowered, rf"[^\p{{L}}\p{{N}}_{WS}]", ""), f"[{WS}]+", " ")


def rstrip_chars(c: Column | str, chars: str) -> Column:
    return F.rtrim(_col(c), F.lit(chars))


def extract_doi(c: Column | str) -> Column:
    """The DOI in a text, or null.

    A resolver address gives all that follows the host; any other text gives the first
    DOI-like run without closing punctuation.
    """
    text = trim_u(c)
    by_url = F.regexp_extract(text, DOI_URL, 1)
    anywhere = rstrip_chars(F.regexp_extract(text, DOI_ANYWHERE, 0), LINK_TAIL)
    return F.when(by_url != "", trim_u(by_url)).when(anywhere != "", anywhere)


def dedup_link_cell(c: Column | str) -> Column:
    """Drop repeated links of a comma-separated cell; the first spelling and its suffix stay.

    Two links are one if their DOIs are equal or, without a DOI, their texts but for closing
    punctuation and the white space before it, case ignored. Null, blank and ``nan`` give the empty string.
    """
    c = _col(c)
    items = F.filter(F.transform(F.split(c, ","), trim_u), lambda x: x != "")
    # Step by step, as nothing within a lambda is computed once for two uses.
    cores = F.transform(items, lambda x: F.struct(x.alias("item"), trim_u(F.regexp_replace(x, COUNT_SUFFIX, "")).alias("core")))
    found = F.transform(cores, lambda x: F.struct(x["item"].alias("item"), x["core"].alias("core"), F.regexp_extract(x["core"], DOI_URL, 1).alias("url"), F.regexp_extract(x["core"], DOI_ANYWHERE, 0).alias("doi")))

    def key(x: Column) -> Column:
        doi = F.when(x["url"] != "", trim_u(x["url"])).otherwise(rstrip_chars(x["doi"], LINK_TAIL))
        return F.when(doi != "", F.concat(F.lit("doi:"), F.lower(doi))).otherwise(F.concat(F.lit("url:"), F.lower(trim_u(rstrip_chars(x["core"], LINK_TAIL)))))

    keyed = F.transform(found, lambda x: F.struct(x["item"].alias("item"), key(x).alias("key")))
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        keyed,
        F.struct(none.alias("keys"), none.alias("items")),
        lambda acc, x: F.when(F.array_contains(acc["keys"], x["key"]), acc).otherwise(F.struct(F.array_append(acc["keys"], x["key"]).alias("keys"), F.array_append(acc["items"], x["item"]).alias("items"))),
        lambda acc: F.array_join(acc["items"], ", "),
    )
    empty = c.isNull() | is_blank(c) | (F.lower(trim_u(c)) == "nan")
    return F.when(empty, "").otherwise(kept)


def strip_file_suffix(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), FILE_SUFFIXES, "")


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)


def context_file_name(query: Column | str, kind: str, limit: int | None = None, stamp: Column | None = None) -> Column:
    """File name for the contexts of a query: lower case, blanks, ``-`` and ``/`` become ``_``."""
    safe = F.translate(F.lower(_col(query)), " -/", "___")
    safe = F.regexp_replace(safe, r"[^\p{L}\p{N}_]", "")
    safe = F.regexp_replace(safe, "^_+|_+$", "")
    parts = [safe, F.lit("_" + CONTEXT_FILE_KINDS.get(kind, "contexts"))]
    if limit:
        parts.append(F.lit(f"_{limit}"))
    if stamp is not None:
        parts += [F.lit("_"), F.date_format(stamp, "yyyyMMdd_HHmmss")]
    return F.concat(*parts, F.lit(".json"))


def first_braces(c: Column | str, greedy: bool) -> Column:
    """From the first ``{`` to the last ``}``, or the first brace group without an inner ``}``; null if none."""
    found = F.regexp_extract(_col(c), r"(?s)\{.*\}" if greedy else r"\{[^}]+\}", 0)
    return F.when(found != "", found)


def truthy_id(c: Column | str) -> Column:
    """An id as BIGINT, 0 and what is no number as null."""
    c = _col(c).try_cast("bigint")
    return F.when(c != 0, c)


def finite(c: Column | str) -> Column:
    """NaN and infinite values as null."""
    c = _col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
