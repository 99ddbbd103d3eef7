"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic) of so many tokens. Each value of a margin has a target, its share of the
`share` of all tokens that are to be drawn; no target exceeds what the value has, and what it lacks for that reason goes to the
others. Raking makes the cells' weights meet the targets: in each round, for each margin in turn, weight * target / (sum of
weights in the margin's value), but never more than the cell has. A document is kept with probability weight / tokens of its cell,
so weights are what is drawn, in expectation. Margins whose targets contradict each other, given what the cells have, are not met in
full: `margins` gives targets and what is drawn. The draw is a hash of doc_id, so it is the same in every run and for every layout
of the data.

Everything is DataFrame operations. Partial sums by cell come before the only shuffle; `mixture` reads the texts once, `mixed`
twice, and no text is shuffled. The table of cells has a row for each combination of three categories. If there are no more than
`held` of them, which is counted, raking runs in windows in one task, without an exchange, and cells are broadcast to the documents;
else cells stay dealt by the margin at hand, and are joined by shuffle.

Topics, for tables without a column `topic`, are those of the keywords that a text has most of; without any, a text with many
marks is a listing, one with many digits has figures, and the rest is general. A null category counts as the empty string. A document
has one token at least, so texts that are null or empty have a weight. Rows that repeat a doc_id share their draw; those
without doc_id too. Other columns pass through `mixed`, whatever their names. Without documents there are no cells.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from corvane.llm.common import cut, free, named

WORD = "[^\\x20\\x09-\\x0D]+"
LETTERS = "[A-Za-z]+"
MARKS = "#*$%&|<>"
KEYWORDS = {
    "law": "court lawyer legal license contract rights agreement clause liability statute tribunal defendant",
    "technology": "software code data computer server api function token password network database kernel",
    "science": "science energy species theory experiment physics chemistry molecule research laboratory genome orbit",
    "health": "health patient doctor disease clinical medicine therapy symptoms hospital vaccine surgery diagnosis",
    "business": "market price company customer shipping sales bank tax invoice payment investor revenue",
    "sport": "game team player season match league coach score tournament championship goalkeeper stadium",
}


@dataclass(frozen=True)
class Params:
    """share: of all tokens, kept in expectation. rounds: of raking, at most; it ends when no margin is off by more than `close` of all. power: the
    target share of a margin's value is its share of tokens to this power, normed (1 keeps, 0 levels), unless targets gives shares by
    margin and value (values it leaves out get 0). held: most cells in one task. keywords: of topics, by words with spaces between."""

    share: float = 0.5
    rounds: int = 12
    close: float = 1e-13
    power: dict = field(default_factory=lambda: {"source": 0.5, "lang": 0.7, "topic": 0.5})
    targets: dict = field(default_factory=dict)
    held: int = 50_000
    keywords: dict = field(default_factory=lambda: dict(KEYWORDS))


DIMS = ("source", "lang", "topic")


def tokens(text: Column) -> Column:
    """The words of a text, 1 at least."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)), F.lit(1)).cast("bigint")


def keyed(text: Column, p: Params) -> Column:
    """The keywords in a text, in order."""
    every = sorted({w for x in p.keywords.values() for w in x.split()})
    words = F.transform(F.coalesce(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0)), F.array().cast("array<string>")), F.lower)
    return F.filter(words, lambda w: w.isin(every))


def topic(text: Column, hits: Column, p: Params) -> Column:
    """The topic with most of the keywords in hits (the first of equals); if there are none, by the form of the text."""
    among = lambda words: F.size(F.filter(hits, lambda w: w.isin(words)))
    counts = {t: among(x.split()) for t, x in p.keywords.items()}
    most = F.greatest(F.lit(0), F.lit(0), *counts.values())
    size = F.coalesce(F.length(text), F.lit(0))
    without = lambda chars: size - F.coalesce(F.length(F.translate(text, chars, "")), F.lit(0))
    out = F.when((most == 0) & (without(MARKS) * 50 > size), "listing").when((most == 0) & (without("0123456789") * 50 > size), "figures").when(most == 0, "general")
    if not counts:
        return out
    *others, last = counts
    for t in others:
        out = out.when(counts[t] == most, t)
    return out.otherwise(last)  # never null, so a join on it needs no look at it first


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from a hash of doc_id."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def celled(docs: DataFrame, p: Params, x: str) -> DataFrame:
    """docs with {x}source, {x}lang, {x}topic, {x}tokens."""
    category = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    out = docs.select("*", *(category(c).alias(f"{x}{c}") for c in ("source", "lang")), tokens(docs["text"]).alias(f"{x}tokens"))
    if "topic" in docs.columns:
        return out.withColumn(f"{x}topic", category("topic"))
    return out.withColumn(f"{x}hits", keyed(docs["text"], p)).withColumn(f"{x}topic", topic(docs["text"], F.col(f"{x}hits"), p)).drop(f"{x}hits")


def filled(values: DataFrame, aim: float) -> DataFrame:
    """values(dim, value, s, g) with t: for each dimension, shares of aim in proportion to g, none over s. The levels come from sums alone, in a
    few rounds."""
    levels: dict[str, float] = {}
    level = lambda: F.create_map(*[F.lit(x) for kv in levels.items() for x in kv])[F.col("dim")] if levels else F.lit(None).cast("double")
    while True:
        full = F.coalesce(F.col("g") * level() >= F.col("s"), F.lit(False))
        found = values.groupBy("dim").agg(F.sum(F.when(full, F.col("s")).otherwise(0.0)).alias("held"), F.sum(F.when(full, 0.0).otherwise(F.col("g"))).alias("open")).collect()
        now = {r["dim"]: max(levels.get(r["dim"], 0.0), (aim - r["held"]) / r["open"]) if r["open"] else float("inf") for r in found}
        if now == levels:
            return values.withColumn("t", F.when(F.col("g") > 0, F.least("s", F.col("g") * level())).otherwise(0.0))
        levels = now


def raked(cells: DataFrame, p: Params) -> tuple[DataFrame, bool]:
    """cells(source, lang, topic, n) with weight (tokens to be drawn), prob (of a document to be drawn) and t_source, t_lang, t_topic (targets of
    the cell's values); and whether they are few."""
    cells = cut(cells)
    count, total = cells.agg(F.count("*"), F.sum("n")).first()
    few, aim = count <= p.held, p.share * (total or 0.0)
    whole = lambda df: df.coalesce(1) if few else df
    values = whole(cells).select("n", F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in DIMS))).alias("x")).groupBy("x.dim", "x.value").agg(F.sum("n").alias("s"))
    given = F.lit(None).cast("double")
    for d in DIMS:
        if d in p.targets:
            mine = F.coalesce(F.create_map(*[F.lit(x) for kv in p.targets[d].items() for x in kv])[F.col("value")], F.lit(0.0))
        else:
            mine = F.pow(F.col("s") / F.lit(total), F.lit(float(p.power[d])))
        given = F.when(F.col("dim") == d, mine.cast("double")).otherwise(given)
    targets = filled(cut(values.withColumn("g", given)), aim)
    cells = whole(cells).withColumn("weight", F.col("n") * p.share)
    for d in DIMS:
        t = targets.where(F.col("dim") == d).select(F.col("value").alias(d), F.col("t").alias(f"t_{d}"))
        cells = cells.join(F.broadcast(t) if few else t, d)
    cells = cut(cells)
    for i in range(p.rounds):
        last, off = i % 6 == 5 or i == p.rounds - 1, F.lit(0.0)
        for d in DIMS:
            now = F.sum("weight").over(Window.partitionBy(d))
            scaled = F.least(F.col("n"), F.coalesce(F.try_divide(F.col("weight") * F.col(f"t_{d}"), now), F.lit(0.0)))
            off = F.greatest(off, F.abs(now - F.col(f"t_{d}")))
            cells = whole(cells).select(*DIMS, "n", *(f"t_{x}" for x in DIMS), scaled.alias("weight"), *([off.alias("off")] if last else []))
            off = F.col("off") if last else F.lit(0.0)
        if last:
            seen = Observation()
            cells = cut(cells.observe(seen, F.max("off").alias("off")))
            if (seen.get["off"] or 0.0) <= p.close * aim:
                break
    return cut(cells.withColumn("prob", F.least(F.lit(1.0), F.col("weight") / F.col("n")))), few


def sums(rows: DataFrame, x: str) -> DataFrame:
    """The cells of celled rows."""
    return rows.groupBy(*(F.col(f"{x}{d}").alias(d) for d in DIMS)).agg(F.sum(f"{x}tokens").cast("double").alias("n"))


def joined(rows: DataFrame, p: Params, x: str) -> DataFrame:
    """Celled rows with the weight and prob of their cells, as {x}weight and {x}prob."""
    cells, few = raked(sums(rows, x), p)
    cells = cells.select(*(F.col(d).alias(f"{x}{d}") for d in DIMS), F.col("weight").alias(f"{x}weight"), F.col("prob").alias(f"{x}prob"))
    return rows.join(F.broadcast(cells) if few else cells, [f"{x}{d}" for d in DIMS])


def mixture(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text, source, lang): source, lang, topic, n_tokens, weight (of its cell, rounded), prob (rounded), kept."""
    x = free("mix_", docs)
    rows = cut(celled(docs, p, x).select(F.col("doc_id").alias("doc_id"), *(f"{x}{d}" for d in DIMS), f"{x}tokens"))
    out = joined(rows, p, x)
    return out.select("doc_id", *(F.col(f"{x}{d}").alias(d) for d in DIMS), F.col(f"{x}tokens").alias("n_tokens"), F.round(f"{x}weight", 3).alias("weight"), F.round(f"{x}prob", 6).alias("prob"), (draw(F.col("doc_id")) < F.col(f"{x}prob")).alias("kept"))


def mixed(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that are drawn, with all their columns."""
    x = free("mix_", docs)
    out = joined(celled(docs, p, x), p, x).where(draw(F.col("doc_id")) < F.col(f"{x}prob"))
    return out.select(*map(named, docs.columns))


def margins(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each dimension and value: target, had and drawn, as shares of the tokens aimed at, of all tokens before the draw, and of those
    drawn in expectation."""
    x = free("mix_", docs)
    cells, _ = raked(sums(celled(docs, p, x), x), p)
    all_, kept, out = *(cells.agg(F.sum("n"), F.sum("weight")).first()), None
    share = lambda c, of: F.coalesce(F.try_divide(F.col(c), F.lit(of)), F.lit(0.0))
    for d in DIMS:
        by = cells.groupBy(F.col(d).alias("value")).agg(F.sum("n").alias("n"), F.sum("weight").alias("kept"), F.first(f"t_{d}").alias("t"))
        rows = by.select(F.lit(d).alias("dimension"), "value", share("t", p.share * (all_ or 0.0)).alias("target"), share("n", all_).alias("had"), share("kept", kept).alias("drawn"))
        out = rows if out is None else out.unionByName(rows)
    return out


def sql(source: str, p: Params = Params()) -> str:
    """DuckDB's SQL for mixture over the table or CTE `source` (doc_id, text, lang, source), as text without a final SELECT: its last CTE is
    `mixture`."""
    size, marks, digits = "coalesce(length(text), 0)", f"coalesce(length(translate(text, '{MARKS}', '')), 0)", "coalesce(length(translate(text, '0123456789', '')), 0)"
    quoted = lambda words: ", ".join(f"'{w}'" for w in words.split())
    n = {t: f"len(list_filter(hits, lambda w: w IN ({quoted(x)})))" for t, x in p.keywords.items()}
    ctes = [
        f"m0 AS (SELECT *, coalesce(source, '') AS _source, coalesce(lang, '') AS _lang, greatest(len(regexp_extract_all(coalesce(text, ''), '{WORD}')), 1)::BIGINT AS _tokens, list_transform(regexp_extract_all(coalesce(text, ''), '{LETTERS}'), lambda w: lower(w)) AS hits FROM {source})",
        "m1 AS (SELECT *, " + ", ".join(f"{x} AS n_{t}" for t, x in n.items()) + " FROM m0)",
        f"m2 AS (SELECT *, greatest({', '.join(f'n_{t}' for t in n)}) AS most FROM m1)",
        f"m3 AS (SELECT *, CASE WHEN most = 0 AND ({size} - {marks}) * 50 > {size} THEN 'listing' WHEN most = 0 AND ({size} - {digits}) * 50 > {size} THEN 'figures' WHEN most = 0 THEN 'general' {' '.join(f'''WHEN n_{t} = most THEN '{t}' ''' for t in n)} END AS _topic FROM m2)",
        "c0 AS (SELECT _source, _lang, _topic, sum(_tokens)::DOUBLE AS n FROM m3 GROUP BY ALL)",
        f"aim AS (SELECT sum(n) AS total, {p.share} * sum(n) AS aim FROM c0)",
    ]
    for d in DIMS:
        order = f"OVER (ORDER BY g / s DESC, _{d} ROWS BETWEEN"
        ctes += [
            f"v_{d} AS (SELECT _{d}, sum(n) AS s, pow(sum(n) / (SELECT total FROM aim), {float(p.power[d])}) AS g FROM c0 GROUP BY 1)",
            f"u_{d} AS (SELECT *, ((SELECT aim FROM aim) - coalesce(sum(s) {order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(g) {order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS c FROM v_{d})",
            f"t_{d} AS (SELECT _{d}, least(s, g * (SELECT coalesce(max(c), 1e300) FROM u_{d} WHERE c >= 0 AND c * g / s <= 1)) AS t_{d} FROM u_{d})",
        ]
    ctes.append(f"r0 AS MATERIALIZED (SELECT *, n * {p.share} AS weight FROM c0 " + " ".join(f"JOIN t_{d} USING (_{d})" for d in DIMS) + ")")
    step = 0
    for _ in range(p.rounds):
        for d in DIMS:
            ctes.append(f"r{step + 1} AS MATERIALIZED (SELECT * REPLACE (least(n, weight * t_{d} / sum(weight) OVER (PARTITION BY _{d})) AS weight) FROM r{step})")
            step += 1
    ctes += [
        f"w0 AS (SELECT _source, _lang, _topic, weight, least(1.0, weight / n) AS p FROM r{step})",
        "mixture AS (SELECT m3.* EXCLUDE (hits), round(weight, 3) AS weight, round(p, 6) AS prob, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < p AS kept FROM m3 JOIN w0 USING (_source, _lang, _topic))",
    ]
    return ",\n".join(ctes)
