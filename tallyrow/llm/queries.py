"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrow.llm import bpe, clauses, darts, hypervectors, kneser_ney, mixing, neighbours, packing, phrases, runs, search, subwords, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(of: int, key: str = "doc_id") -> Column:
    """The share of ``of`` equal ones that a row falls into. Null for a null key: such rows are in none, neither learned from nor held out."""
    return F.crc32(F.col(key).cast("string")) % of


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", (fold(7) == 2).alias("held_out"), "text")
    return kneser_ney.score(docs, kneser_ney.fit(docs.where(~F.col("held_out")).select("text")))


def _judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    asked = docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search.search(search.build(docs), asked)


# The targets of op3_mix and of the pipeline: whole-number weights among siblings.
DOMAIN_SQL = "concat('domain', cast(coalesce(try_cast(substring(source, 4) as int), 0) % 4 as string))"
MIX_LEVELS = ("domain", "lang", "source")
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
MIX_EPOCHS, MIX_SEED = 4, 17


def _case(column: str, weights: dict[str, int]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {v}" for k, v in weights.items()) + " else 1 end"


MIX_WEIGHTS_SQL = (_case("domain", DOMAIN_WEIGHTS), _case("lang", LANG_WEIGHTS), "1")


def mixture(docs: DataFrame) -> tuple[DataFrame, mixing.Mixture]:
    """``docs`` with domain and n_tokens, and what the standing targets keep of them."""
    measured = docs.withColumns({"domain": F.expr(DOMAIN_SQL), "n_tokens": mixing.n_tokens()})
    weights = [F.expr(w) for w in MIX_WEIGHTS_SQL]
    return measured, mixing.plan(measured, MIX_LEVELS, weights, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    measured, found = mixture(docs)
    return found.copies(measured.drop("text"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return darts.classes(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = clauses.fit(docs, _table(spark, sf_dir, "labels"), "toxic", fold(5) != 0)
    return _judged(clauses.score(docs, weights), fold(5) == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = subwords.fit(docs, _table(spark, sf_dir, "labels"), "quality", fold(3) != 1)
    return _judged(subwords.score(docs, model), fold(3) == 1)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the measured recall, which SQL cannot know."""
    return neighbours.near_duplicates(_table(spark, sf_dir, "embeddings")).drop("recall", "recall_links")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = hypervectors.predict(docs.select("doc_id", "text"), hypervectors.fit(docs, fold(5) != 0))
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs.select("doc_id", mixing.n_tokens().alias("n_tokens")))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    hashed, n = F.crc32(F.col("doc_id").cast("string")), mixing.n_tokens()
    first = F.expr("_g % _n")
    period = F.expr("1 + (_n - _g % _n) div (3 + _g % 8)")
    planted = (
        docs.withColumn("_g", F.when(hashed % 10 == 0, F.floor(hashed / 10)))
        .withColumn("_n", F.when(F.col("_g").isNotNull(), n))
        .withColumn("repeat", F.when(F.col("_n") > 0, F.struct(first.alias("first"), period.alias("period"))))
    )
    found = runs.repetitions(planted.select("doc_id", "text", "repeat"), repeat="repeat")
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    # Runs come by start, then period: the first of equals stays.
    found = found.withColumn("best", F.aggregate("runs", none, lambda a, r: F.when(better(a, r), r).otherwise(a)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    automaton = bpe.read(public_tokenizers.path("word_bpe_49k.json"))
    coded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), automaton)
    return bpe.decode(coded, automaton).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_search": op2_search,
    "op3_mix": op3_mix,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_near_vectors": op7_near_vectors,
    "op8_language": op8_language,
    "op9_warc": op9_warc,
    "op10_pack": op10_pack,
    "op11_runs": op11_runs,
    "op12_collocations": op12_collocations,
    "op13_bpe": op13_bpe,
}

def _budget_sql(depth: int) -> str:
    """CTEs nodes, ranked and given of one level, from those of the level above."""
    names = ", ".join(MIX_LEVELS[:depth])
    parents = ", ".join(MIX_LEVELS[: depth - 1])
    by = f"partition by {parents}, late" if parents else "partition by late"
    whole = f"partition by {parents}" if parents else ""
    above = (
        f"(select {parents}, budget from given{depth - 1})" if parents else "(select sum(cap) // {e} as budget from leaves)".format(e=MIX_EPOCHS)
    )
    join = f"join {above} p using ({parents})" if parents else f"cross join {above} p"
    return f"""
    nodes{depth} as (
      select n.*, p.budget as b, (w <= 0)::int as late, case when w > 0 then w else 1 end as v
      from (select {names}, sum(cap) as cap, max(w{depth}) as w from leaves group by {names}) n {join}
    ),
    rooms{depth} as (
      select * replace (case when late = 0 then least(b, room) else greatest(b - room, 0) end as b)
      from (select *, coalesce(sum(cap) filter (where late = 0) over ({whole}), 0) as room from nodes{depth})
    ),
    ranked{depth} as (
      select *, (cap::hugeint * sum(v) over ({by} order by cap / v, {names} rows between current row and unbounded following)
        <= (b - coalesce(sum(cap) over ({by} order by cap / v, {names} rows between unbounded preceding and 1 preceding), 0))::hugeint * v)::int as is_full
      from rooms{depth}
    ),
    opened{depth} as (
      select *, sum(case when is_full = 0 then v else 0 end) over ({by}) as open_w,
        b - sum(case when is_full = 1 then cap else 0 end) over ({by}) as open_b from ranked{depth}
    ),
    shared{depth} as (
      select *, case when is_full = 1 then cap else open_b::hugeint * v // open_w end as share from opened{depth}
    ),
    given{depth} as (
      select {names}, share + (is_full = 0 and turn <= spare)::int as budget
      from (select *, b - sum(share) over ({by}) as spare, row_number() over ({by} order by is_full, v desc, {names}) as turn from shared{depth})
    )"""


_ORDER_SQL = "('0x' || substr(md5('{seed}:' || epochs || ':' || doc_id), 1, 15))::bigint"

OP3_SQL = f"""
    with docs as (
      select doc_id, 'domain' || (coalesce(try_cast(substring(source, 4) as int), 0) % 4) as domain, lang, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as n_tokens
      from documents
    ),
    leaves as (
      select *, {", ".join(f"{w} as w{i}" for i, w in enumerate(MIX_WEIGHTS_SQL, 1))}
      from (select domain, lang, source, sum(n_tokens) as supply, sum(n_tokens) * {MIX_EPOCHS} as cap from docs group by all)
    ),
    {",".join(_budget_sql(d) for d in (1, 2, 3))},
    placed as (
      select *, {_ORDER_SQL.format(seed=MIX_SEED)} as place
      from (
        select d.*, case when supply > 0 then budget // supply else 0 end as epochs, case when supply > 0 then budget % supply else 0 end as rest
        from docs d join leaves using (domain, lang, source) join given3 using (domain, lang, source)
      )
    )
    select doc_id, domain, lang, source, n_tokens, (epochs + (sofar < rest)::int)::bigint as copies
    from (
      select *, coalesce(sum(n_tokens) over (
        partition by domain, lang, source order by place, doc_id rows between unbounded preceding and 1 preceding), 0) as sofar
      from placed
    )
    where epochs + (sofar < rest)::int > 0
"""

OP9_SQL = """
    with heads as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
    kept as (select *, max(page_id) over (partition by payload_digest) as original from heads)
    select page_id, payload_bytes, payload_digest,
      case when payload_bytes >= 1000 and page_id <> original then 'revisit' else 'response' end as record_type,
      case when payload_bytes >= 1000 and page_id <> original then original end as refers_to
    from kept
"""

OP12_SQL = """
    with texts as (
      select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
      from documents
    ),
    pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) as piece from texts),
    lists as (select lang, row_number() over () as id, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from pieces),
    spots as (select lang, id, unnest(words) as w1, generate_subscripts(words, 1) as i from lists),
    rows_ as materialized (
      select lang, w1, w1 || ' ' || lead(w1, 1) over p as w2, lead(w1, 2) over p as w3, lead(w1, 3) over p as w4, lead(w1, 4) over p as w5
      from spots window p as (partition by id order by i)
    ),
    grams as (
      select lang, 1 as k, w1 as phrase from rows_
      union all select lang, 2, w2 from rows_ where w2 is not null
      union all select lang, 3, w2 || ' ' || w3 from rows_ where w3 is not null
      union all select lang, 4, w2 || ' ' || w3 || ' ' || w4 from rows_ where w4 is not null
      union all select lang, 5, w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 from rows_ where w5 is not null
    ),
    f as materialized (select lang, k, phrase, count(*)::bigint as f from grams group by all),
    totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
    often as (select lang, k, phrase, f as a, string_split(phrase, ' ') as words from f where k > 1 and f >= 100),
    cuts as (select lang, phrase, a, k, words, j, array_to_string(words[1:j], ' ') as head, array_to_string(words[j + 1:], ' ') as rest
      from often, range(1, 5) t(j) where j < k),
    scored as (
      select c.lang, c.phrase, c.a, x.f as l, y.f as r, n, j, (1000::hugeint * a * n // (x.f::hugeint * y.f))::bigint as score
      from cuts c join f x on x.lang = c.lang and x.phrase = c.head join f y on y.lang = c.lang and y.phrase = c.rest
      join totals t on t.lang = c.lang
    ),
    weakest as (select *, row_number() over (partition by lang, phrase order by score, j) as turn from scored),
    inner_ as (select distinct s.lang, array_to_string(s.words[i:i + m - 1], ' ') as phrase, s.a
      from often s, range(2, 5) t(m), range(1, 5) u(i) where m < k and i + m - 1 <= k),
    longer as (select lang, phrase, max(a) as most from inner_ group by all),
    ranked as (
      select w.lang, w.phrase, a, l, r, n, score, row_number() over (partition by w.lang order by score desc, a desc, w.phrase) as rank
      from weakest w left join longer g on g.lang = w.lang and g.phrase = w.phrase
      where turn = 1 and (most is null or 100 * most < 100 * a)
    )
    select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""

OP4_SQL = """
    with recursive docs as (
      select doc_id, coalesce(text, '') as text, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low
      from documents
    ),
    texts as (
      select min(doc_id) as id, text, regexp_extract_all(any_value(low), '[^\\x20\\x09-\\x0D]+') as words from docs group by text
    ),
    shingles as materialized (
      select distinct id, unnest(case when len(words) < 5 then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as s
      from texts where len(words) > 0
    ),
    sizes as (select id, count(*) as n from shingles group by id),
    links as materialized (
      select p.a, p.b from (select x.id as a, y.id as b, count(*) as c from shingles x join shingles y on x.s = y.s and x.id <> y.id group by all) p
      join sizes m on m.id = p.a join sizes k on k.id = p.b where 5 * c >= 4 * (m.n + k.n - c)
    ),
    reach as (select id, id as member from texts union select r.id, l.b from reach r join links l on l.a = r.member),
    classes as (select id, min(member) as class_id from reach group by id)
    select doc_id, class_id from docs join texts using (text) join classes using (id)
"""

OP7_SQL = """
    with recursive vectors as (
      select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
    ),
    sized as (select *, list_max(list_transform(v, lambda x: abs(x))) as most from vectors),
    valid as materialized (
      select vec_id, label, list_transform(v, lambda x: x / most) as e from sized
      where label is not null and len(v) > 0 and list_bool_and(list_transform(v, lambda x: coalesce(isfinite(x), false))) and most > 0
    ),
    links as materialized (
      select x.vec_id as a, y.vec_id as b from valid x join valid y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e)
      where list_cosine_similarity(x.e, y.e) >= 0.98
    ),
    reach as (select vec_id, vec_id as member from vectors union select r.vec_id, l.b from reach r join links l on l.a = r.member),
    classes as (select vec_id, min(member) as component_id from reach group by vec_id),
    counted as (select a as vec_id, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
    from classes left join counted using (vec_id)
"""

ORACLES: dict[str, str] = {"op3_mix": OP3_SQL, "op4_near_duplicates": OP4_SQL, "op7_near_vectors": OP7_SQL, "op9_warc": OP9_SQL, "op12_collocations": OP12_SQL}
