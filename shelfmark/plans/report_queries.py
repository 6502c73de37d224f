"""Column jobs: byte counts, text, responses, and the Python kernels."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.python_kernels import star_map as apply_star_map
from shelfmark.functions.sizes import SYMBOLS, readable_bytes
from shelfmark.operators import reports
from shelfmark.plans import fixtures as fx
from shelfmark.plans.registry import query


def _readable_sql(n: str, symbols: str) -> str:
    """Rounds half to even on exact integers, unlike printf."""
    arms = []
    for step in range(6, -1, -1):
        unit, name = 1 << (10 * step), SYMBOLS[symbols][step]
        tenths = f"((cast({n} as hugeint) * 10) // {unit})"
        rest = f"((cast({n} as hugeint) * 10) % {unit})"
        up = f"case when 2 * {rest} > {unit} or (2 * {rest} = {unit} and {tenths} % 2 = 1) then 1 else 0 end"
        text = f"(({tenths} + {up}) // 10) || '.' || (({tenths} + {up}) % 10) || ' {name}'"
        arms.append(f"when {n} >= {unit} then {text}" if step else f"else {text}")
    return f"case {' '.join(arms)} end"


@query(
    f"""
    select parent, count(*) as n_files, cast(sum(size) as bigint) as n_bytes,
           {_readable_sql('sum(size)', 'customary')} as readable
    from objects where type = 'file' group by parent
    """,
    views=("objects",),
)
def storage_usage(spark, sf_dir):
    return reports.storage_usage(fx.objects(spark, sf_dir))


@query(
    "select k, ln, n, "
    + ", ".join(f"{_readable_sql('n', family)} as {family}" for family in SYMBOLS)
    + " from byte_counts",
    views=("byte_counts",),
    name="readable_bytes",
)
def readable_byte_counts(spark, sf_dir):
    counts = fx.byte_counts(spark, sf_dir)
    return counts.select(
        "k", "ln", "n", *[readable_bytes(F.col("n"), symbols=family).alias(family) for family in SYMBOLS]
    )


def _padded_sql(n: str, symbols: str) -> str:
    """Whole units, and one digit after the point filled up to eight signs."""
    whole, padded = [], []
    for step in range(6, -1, -1):
        unit, name = 1 << (10 * step), SYMBOLS[symbols][step]
        number = f"split_part({_readable_sql(n, symbols)}, ' ', 1)"
        arm = f"when {n} >= {unit} then" if step else "else"
        whole.append(f"{arm} cast(floor(cast({n} as double) / {unit}) as bigint) || ' {name}'")
        padded.append(f"{arm} lpad({number}, 8, '0') || rpad('{name}', 5, ' ') || '|'")
    return f"case {' '.join(whole)} end as cut, case {' '.join(padded)} end as padded"


@query(f"select k, ln, n, {_padded_sql('n', 'iec')} from byte_counts", views=("byte_counts",))
def readable_formats(spark, sf_dir):
    n = F.col("n")
    return fx.byte_counts(spark, sf_dir).select(
        "k",
        "ln",
        "n",
        readable_bytes(n, "%(value)d %(symbol)s", "iec").alias("cut"),
        readable_bytes(n, "%(value)08.1f%(symbol)-5s|", "iec").alias("padded"),
    )


@query("select doc_id, replace(text, '. ', ' $1\\E ') as text from documents")
def rewrite_text(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return reports.rewrite_text(docs, "text", ". ", " $1\\E ")


@query("select doc_id, regexp_replace(text, 'THE', '<$>', 'gi') as text from documents")
def rewrite_text_ignore_case(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return reports.rewrite_text(docs, "text", "THE", "<$>", ignore_case=True)


@query(
    """
    select rid, endpoint, status, case
        when endpoint = 'stat' and status = 500 and code = 'ERR_DOES_NOT_EXIST' then 'not_found'
        when endpoint = 'stat' and status = 400 then 'bad_request'
        when endpoint = 'list' and status = 500 and code = 'ERR_DOES_NOT_EXIST' then 'invalid_path'
        when endpoint = 'upload' and status = 500 and code = 'ERR_EXISTS' then 'skipped'
        when endpoint = 'download' and status = 500 and code = 'ERR_REQUEST_FAILED' then 'invalid_path'
        when endpoint = 'token' and status = 400 then 'unauthorized'
        when endpoint = 'token' and status <> 200 then 'bad_response'
        when status >= 400 then 'http_error' else 'ok' end as outcome
    from (select *, json_extract_string(body, '$.error_code') as code from resplog)
    """,
    views=("resplog",),
)
def classify_responses(spark, sf_dir):
    classified = reports.classify_responses(fx.resplog(spark, sf_dir))
    return classified.select("rid", "endpoint", "status", "outcome")


@query("select rid, list_contains(json_keys(body), 'paths') as complete from resplog", views=("resplog",))
def require_keys(spark, sf_dir):
    return reports.require_keys(fx.resplog(spark, sf_dir), ["paths"]).select("rid", "complete")


@query(
    "select rid, coalesce(json_type(body, '$.paths') <> 'NULL', false) as complete from resplog",
    views=("resplog",),
)
def require_non_null_keys(spark, sf_dir):
    checked = reports.require_keys(fx.resplog(spark, sf_dir), ["paths"], nulls_count=False)
    return checked.select("rid", "complete")


@query(
    """
    select rid, path, coalesce(cast(json_extract(body, '$.paths."' || path || '"') as boolean), false) as "exists"
    from resplog
    """,
    views=("resplog",),
)
def extract_entry(spark, sf_dir):
    return reports.extract_entry(fx.resplog(spark, sf_dir)).select("rid", "path", "exists")


@query("select event_id, cast(json_merge_patch('{}', j) as varchar) as j from null_documents", views=("null_documents",))
def strip_null_keys(spark, sf_dir):
    return reports.strip_nulls(fx.null_documents(spark, sf_dir), "j")


def _count_pieces(lang: str, text: str) -> str:
    return f"{lang}:{len(text.split(' '))}"


@query("select doc_id, lang || ':' || len(string_split(text, ' ')) as pieces from documents")
def star_map(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    mapped = apply_star_map(docs, _count_pieces, ["lang", "text"], "pieces", T.StringType())
    return mapped.select("doc_id", "pieces")
