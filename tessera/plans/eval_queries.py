"""Generation-evaluation queries and their oracles.

References are whole ``documents.text``; the generators are the reference's
baseline kinds re-aimed at the driver tables:

* ``empty``      - the empty string;
* ``copy_title`` - copy the input's name (here: the document's first line);
* ``copy_spec``  - the rendered spec block of the row's structured input;
* ``lookup``     - a stored text looked up by key with '' fallback (here: the
  text of document ``doc_id + 1``).

All generators are columns of one long ``(generator, id, reference,
prediction)`` frame, scored in a single grouped plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import bleu as B
from tessera.functions import text as T
from tessera.operators import dataset as D
from tessera.operators import joins as J
from tessera.operators import metrics as M
from tessera.operators.udf import Model
from tessera.plans import sqlfrag as S
from tessera.plans.registry import register
from tessera.sources.tables import Tables

GENERATORS = ("empty", "copy_title", "copy_spec", "lookup")
# Acceptance bar of the evaluation. The similarity bar was set for sentence embeddings;
# applied to another measure it is that measure's bar, and results name the measure they used.
ACCEPT_SIMILARITY = 0.770
ACCEPT_BLEU = 9.89
ACCEPT_RATIO = (0.7, 1.5)


# ============================================================== Spark side
def predictions(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = t.spread("documents").select(F.col("doc_id").alias("id"), "text")
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    spec_in = D.input_struct(name=F.col("p_name"), brand=F.col("p_brand"), category=F.col("p_type"),
                             size=F.col("p_size").cast("string"), mrp=F.col("p_retailprice"))
    rows = J.lookup_with_fallback(d.join(p, d.id == p.p_partkey, "left"), t.documents.select("doc_id", "text"),
                                  F.col("id") + 1, "doc_id", "text", "lookup", "")
    by_generator = {"empty": F.lit(""), "copy_title": T.first_line(F.col("text")),
                    "copy_spec": D.render_spec_block(D.clean_input(spec_in)), "lookup": F.col("lookup")}
    made = [F.struct(F.lit(g).alias("generator"), by_generator[g].alias("prediction")) for g in GENERATORS]
    return rows.select("id", F.inline(F.array(*made))).select("generator", "id", "prediction")


def references(spark, sf_dir) -> DataFrame:
    return Tables(spark, sf_dir).spread("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("reference"))


def _r(c, d=6):
    return F.round(c, d)


# ============================================================== SQL side
_R1, _R2, _R3, _R4 = (S.lit(p) for p, _ in B.RULES)


def _tok13a(e: str) -> str:
    s = e
    for a, b in B.PRE_REPLACE:
        a_sql = "'-' || chr(10)" if a == "-\n" else ("chr(10)" if a == "\n" else S.lit(a))
        s = f"replace({s}, {a_sql}, {S.lit(b)})"
    s = f"(' ' || {s} || ' ')"
    for (pat, rep) in B.RULES:
        s = f"regexp_replace({s}, {S.lit(pat)}, {S.lit(rep.format('', chr(92) + '1', chr(92) + '2'))}, 'g')"
    return f"list_filter(regexp_split_to_array({s}, {S.WS_RUN}), lambda x: x <> '')"


def _rtok(e: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({e}), '[^a-z0-9]+', ' ', 'g'), "
            f"{S.WS_RUN}), lambda x: x <> '')")


_PREDS = f"""
docs AS (SELECT doc_id AS id, text FROM documents),
preds AS (
  SELECT 'empty' AS generator, id, '' AS prediction FROM docs
  UNION ALL SELECT 'copy_title', id, split_part(text, chr(10), 1) FROM docs
  UNION ALL SELECT 'copy_spec', d.id, {S.spec_block(
      name=f"coalesce({S.clean('p.p_name')}, '')", brand=S.clean('p.p_brand'), category=S.clean('p.p_type'),
      size=S.clean('CAST(p.p_size AS VARCHAR)'), mrp='p.p_retailprice', sku='NULL', material='NULL',
      finish='NULL', length='NULL', breadth='NULL', height='NULL', weight='NULL', tagline='NULL')}
    FROM docs d LEFT JOIN part p ON d.id = p.p_partkey
  UNION ALL SELECT 'lookup', d.id, coalesce(nullif(n.text, ''), '') FROM docs d LEFT JOIN docs n ON n.id = d.id + 1),
refs AS (SELECT id, text AS reference FROM docs)"""

_STATS = f"""
ptok AS (SELECT generator, id, {_tok13a('prediction')} AS tok FROM preds),
rtok AS (SELECT id, {_tok13a('reference')} AS tok FROM refs),
pg AS (SELECT generator, id, n, gram, count(*) AS cp FROM (
         SELECT generator, id, n, unnest(list_transform(range(1, len(tok) - n + 2),
                lambda i: array_to_string(tok[i:i + n - 1], ' '))) AS gram
         FROM ptok, (VALUES (1), (2), (3), (4)) o(n)) GROUP BY ALL),
rg AS (SELECT id, n, gram, count(*) AS cr FROM (
         SELECT id, n, unnest(list_transform(range(1, len(tok) - n + 2),
                lambda i: array_to_string(tok[i:i + n - 1], ' '))) AS gram
         FROM rtok, (VALUES (1), (2), (3), (4)) o(n)) GROUP BY ALL),
mt AS (SELECT generator, id, n, sum(least(cp, cr)) AS m FROM pg JOIN rg USING (id, n, gram) GROUP BY ALL),
mp AS (SELECT generator, id, """ + ", ".join(f"sum(CASE WHEN n = {n} THEN m END) AS m{n}" for n in range(1, 5)) + """
       FROM mt GROUP BY ALL),
st AS (SELECT p.generator, p.id, """ + ", ".join(
    f"CAST(coalesce(mp.m{n}, 0) AS BIGINT) AS m{n}" for n in range(1, 5)) + ", " + ", ".join(
    f"CAST(greatest(len(p.tok) - {n} + 1, 0) AS BIGINT) AS t{n}" for n in range(1, 5)) + """,
       CAST(len(p.tok) AS BIGINT) AS sys_len, CAST(coalesce(len(r.tok), 0) AS BIGINT) AS ref_len
FROM ptok p LEFT JOIN rtok r ON p.id = r.id LEFT JOIN mp ON p.generator = mp.generator AND p.id = mp.id)"""


def _bleu_sql(effective: bool, p: str = "") -> str:
    m = [f"{p}m{n}" for n in range(1, 5)]
    t = [f"{p}t{n}" for n in range(1, 5)]
    sys_len, ref_len = f"{p}sys_len", f"{p}ref_len"
    bp = (f"(CASE WHEN {sys_len} < {ref_len} THEN (CASE WHEN {sys_len} > 0 THEN "
          f"exp(1.0 - {ref_len} / greatest({sys_len}, 1)) ELSE 0.0 END) ELSE 1.0 END)")
    prefix = []
    for i in range(4):
        prefix.append("(" + " AND ".join(f"{t[j]} > 0" for j in range(i + 1)) + ")")
    logs = []
    for i in range(4):
        k = "(" + " + ".join(f"(CASE WHEN {prefix[j]} AND {m[j]} = 0 THEN 1 ELSE 0 END)" for j in range(i + 1)) + ")"
        ts = f"greatest({t[i]}, 1)"
        pv = (f"(CASE WHEN {m[i]} = 0 THEN 100.0 / (pow(2.0, {k}) * {ts}) "
              f"ELSE 100.0 * {m[i]} / {ts} END)")
        logs.append(f"(CASE WHEN {prefix[i]} THEN ln({pv}) ELSE -9999999999.0 END)")
    total = f"({logs[0]} + {logs[1]} + {logs[2]} + {logs[3]})"
    if effective:
        n_act = "(" + " + ".join(f"(CASE WHEN {x} THEN 1 ELSE 0 END)" for x in prefix) + ")"
        eff = logs[0] + "".join(f" + (CASE WHEN {prefix[i]} THEN {logs[i]} ELSE 0.0 END)" for i in range(1, 4))
        mean = f"(CASE WHEN {n_act} > 0 THEN ({eff}) / {n_act} ELSE {total} / 4 END)"
    else:
        mean = f"({total} / 4)"
    return f"(CASE WHEN ({m[0]} + {m[1]} + {m[2]} + {m[3]}) = 0 THEN 0.0 ELSE {bp} * exp({mean}) END)"


def _with(*parts, more=False):
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + (",\n" if more else "\n")


_CORPUS = """
cs AS (SELECT generator, """ + ", ".join(f"sum(m{n}) AS m{n}, sum(t{n}) AS t{n}" for n in range(1, 5)) + """,
       sum(sys_len) AS sys_len, sum(ref_len) AS ref_len FROM st GROUP BY generator)"""

_TFCOS = f"""
pt AS (SELECT generator, id, term, count(*) AS cp FROM (SELECT generator, id, unnest({_rtok('prediction')}) AS term FROM preds) GROUP BY ALL),
rt AS (SELECT id, term, count(*) AS cr FROM (SELECT id, unnest({_rtok('reference')}) AS term FROM refs) GROUP BY ALL),
dt AS (SELECT generator, id, sum(cp * cr) AS dot FROM pt JOIN rt USING (id, term) GROUP BY ALL),
pn AS (SELECT generator, id, sum(cp * cp) AS pp FROM pt GROUP BY ALL),
rn AS (SELECT id, sum(cr * cr) AS rr FROM rt GROUP BY ALL),
cosr AS (SELECT p.generator, p.id,
  CASE WHEN sqrt(CAST(coalesce(pn.pp, 0) AS DOUBLE)) * sqrt(CAST(coalesce(rn.rr, 0) AS DOUBLE)) > 0
       THEN coalesce(dt.dot, 0) / (sqrt(CAST(coalesce(pn.pp, 0) AS DOUBLE)) * sqrt(CAST(coalesce(rn.rr, 0) AS DOUBLE)))
       ELSE 0.0 END AS cosine
  FROM preds p LEFT JOIN pn ON p.generator = pn.generator AND p.id = pn.id LEFT JOIN rn ON p.id = rn.id
  LEFT JOIN dt ON p.generator = dt.generator AND p.id = dt.id)"""


# ============================================================== queries
@register("eval_predictions", sql=_with(_PREDS) + """
SELECT generator, id, length(prediction) AS pred_chars, md5(prediction) AS pred_md5 FROM preds""")
def q_eval_predictions(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.select("generator", "id", F.length("prediction").alias("pred_chars"),
                    F.md5("prediction").alias("pred_md5"))


@register("bleu_stats", sql=_with(_PREDS, _STATS) + """
SELECT * FROM st""")
def q_bleu_stats(spark, sf_dir):
    return M.bleu_stats(predictions(spark, sf_dir), references(spark, sf_dir))


@register("corpus_bleu", sql=_with(_PREDS, _STATS, _CORPUS) + f"""
SELECT generator, round({_bleu_sql(False)}, 6) AS bleu FROM cs""")
def q_corpus_bleu(spark, sf_dir):
    st = M.bleu_stats(predictions(spark, sf_dir), references(spark, sf_dir))
    return M.corpus_bleu(st).select("generator", _r(F.col("bleu")).alias("bleu"))


@register("sentence_bleu", sql=_with(_PREDS, _STATS) + f"""
SELECT generator, round(avg(CASE WHEN sys_len = 0 THEN 0.0 ELSE {_bleu_sql(True)} / 100.0 END), 6) AS bleu
FROM st GROUP BY generator""")
def q_sentence_bleu(spark, sf_dir):
    st = M.bleu_stats(predictions(spark, sf_dir), references(spark, sf_dir))
    s = M.sentence_bleu(st)
    return s.groupBy("generator").agg(_r(F.avg("bleu")).alias("bleu"))


@register("rouge_l")
def q_rouge_l(spark, sf_dir):
    """ROUGE-L F (stemmed, x100) mean per generator; checked against a DP on fixtures."""
    c = M.example_counts(predictions(spark, sf_dir), references(spark, sf_dir), (M.ROUGE,))
    return c.groupBy("generator").agg(F.count(F.lit(1)).alias("n"), _r(F.avg(M.rouge_l_of(c)) * 100.0).alias("rouge_l_f1"))


_TERMS = "CASE WHEN {0} = '' THEN [] ELSE string_split({0}, ' ') END"


@register("rouge_l_turns", sql=f"""
WITH c AS (SELECT conv_id, turn, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS t FROM conversations),
s AS (SELECT conv_id, turn, {_TERMS.format('t')} AS b, lag({_TERMS.format('t')}) OVER (PARTITION BY conv_id ORDER BY turn) AS a FROM c),
l AS (
  SELECT conv_id, turn, len(a) AS ref_terms, len(b) AS pred_terms,
         list_reduce([list_transform(range(0, len(a) + 1), lambda x: 0::BIGINT)] || list_transform(b, lambda w: list_transform(a, lambda x: (x = w)::BIGINT)),
           lambda prev, m: list_reduce([[0::BIGINT]] || list_transform(range(1, len(a) + 1), lambda j: [j]),
             lambda acc, e: list_append(acc, CASE WHEN m[e[1]] = 1 THEN prev[e[1]] + 1 ELSE greatest(prev[e[1] + 1], acc[-1]) END)))[-1] AS lcs
  FROM s WHERE a IS NOT NULL)
SELECT conv_id, turn, lcs, pred_terms, ref_terms, round(CASE WHEN lcs > 0 THEN 2.0 * lcs / (pred_terms + ref_terms) ELSE 0 END, 6) AS rouge_l FROM l""")
def q_rouge_l_turns(spark, sf_dir):
    """ROUGE-L, without stems, of every turn of a conversation against the turn before it."""
    c = Tables(spark, sf_dir).conversations
    before = Window.partitionBy("conv_id").orderBy("turn")
    key = F.struct("conv_id", "turn").alias("id")
    text = F.coalesce("text", F.lit(""))
    preds = c.select(F.lit("turn").alias("generator"), key, text.alias("prediction"))
    refs = c.select(key, F.lag(text).over(before).alias("reference")).where("reference is not null")
    counts = M.example_counts(preds.join(refs.select("id"), "id", "left_semi"), refs, (M.ROUGE,), stemmer=False)
    return counts.select("id.conv_id", "id.turn", "lcs", "pred_terms", "ref_terms", _r(M.rouge_l_of(counts)).alias("rouge_l"))


@register("tf_cosine", sql=_with(_PREDS, _TFCOS) + """
SELECT generator, round(avg(cosine), 6) AS cosine FROM cosr GROUP BY generator""")
def q_tf_cosine(spark, sf_dir):
    c = M.tf_cosine(predictions(spark, sf_dir), references(spark, sf_dir))
    return c.groupBy("generator").agg(_r(F.avg("cosine")).alias("cosine"))


@register("length_ratio", sql=_with(_PREDS) + """
SELECT generator, round(avg(length(p.prediction) / greatest(length(r.reference), 1)), 6) AS length_ratio
FROM preds p JOIN refs r ON p.id = r.id GROUP BY generator""")
def q_length_ratio(spark, sf_dir):
    p = M.pair_texts(predictions(spark, sf_dir), references(spark, sf_dir))
    return p.groupBy("generator").agg(_r(F.avg(M.length_ratio(F.col("prediction"), F.col("reference"))))
                                      .alias("length_ratio"))


def accepted(similarity, bleu, ratio, bar: float = ACCEPT_SIMILARITY):
    """The acceptance gate over a stated similarity measure and its bar."""
    return (similarity > bar) & (bleu > ACCEPT_BLEU) & ratio.between(*ACCEPT_RATIO)


def _results(spark, sf_dir, with_rouge: bool) -> DataFrame:
    preds, refs = predictions(spark, sf_dir), references(spark, sf_dir)
    out = M.generator_scores(M.example_counts(preds, refs, (M.BLEU, M.COSINE, M.ROUGE) if with_rouge else (M.BLEU, M.COSINE)))
    acc = accepted(F.col("tf_cosine"), F.col("bleu"), F.col("length_ratio"))
    cols = ["generator", "n", _r(F.col("bleu")).alias("bleu"),
            _r(F.col("tf_cosine")).alias("tf_cosine"),
            _r(F.col("length_ratio")).alias("length_ratio"), acc.alias("accepted")]
    if with_rouge:
        cols.insert(3, _r(F.col("rouge_l_f1")).alias("rouge_l_f1"))
    return out.select(*cols)


@register("eval_examples", sql=_with(_PREDS, _STATS, _TFCOS) + f"""
SELECT st.generator, st.id, round(CASE WHEN sys_len = 0 THEN 0.0 ELSE {_bleu_sql(True)} / 100.0 END, 6) AS bleu,
       round(cosr.cosine, 6) AS tf_cosine, round(length(p.prediction) / greatest(length(r.reference), 1), 6) AS length_ratio
FROM st JOIN cosr USING (generator, id) JOIN preds p USING (generator, id) JOIN refs r USING (id)""")
def q_eval_examples(spark, sf_dir):
    """The per-example table of the evaluation (I6)."""
    e = M.example_scores(M.example_counts(predictions(spark, sf_dir), references(spark, sf_dir)))
    return e.select("generator", "id", *[_r(F.col(c)).alias(c) for c in ("bleu", "tf_cosine", "length_ratio")])


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _letters_sql(e: str) -> str:
    return "[" + ", ".join(f"CAST(length({e}) - length(replace({e}, '{c}', '')) AS DOUBLE)" for c in _LETTERS) + "]"


@register("embedding_similarity", sql=_with(_PREDS) + f"""
SELECT generator, round(avg(CASE WHEN den > 0 THEN dot / den ELSE 0.0 END), 6) AS similarity FROM (
  SELECT generator, list_sum(list_transform(range(1, 27), lambda i: a[i] * b[i])) AS dot,
         sqrt(list_sum(list_transform(a, lambda x: x * x))) * sqrt(list_sum(list_transform(b, lambda x: x * x))) AS den
  FROM (SELECT generator, {_letters_sql('prediction')} AS a, {_letters_sql('reference')} AS b FROM preds JOIN refs USING (id)))
GROUP BY generator""")
def q_embedding_similarity(spark, sf_dir):
    """Mean similarity under an embedding model (I4): here the counts of the letters a to z."""
    model = Model("letters", "1", lambda: lambda texts: [[t.count(c) for c in _LETTERS] for t in texts])
    c = M.embedding_cosine(predictions(spark, sf_dir), references(spark, sf_dir), model)
    return c.groupBy("generator").agg(_r(F.avg("cosine")).alias("similarity"))


@register("eval_results", sql=_with(_PREDS, _STATS, _CORPUS, _TFCOS, more=True) + f"""
lr AS (SELECT generator, count(*) AS n, avg(length(p.prediction) / greatest(length(r.reference), 1)) AS length_ratio
         FROM preds p JOIN refs r ON p.id = r.id GROUP BY generator),
bl AS (SELECT generator, {_bleu_sql(False)} AS bleu FROM cs),
co AS (SELECT generator, avg(cosine) AS tf_cosine FROM cosr GROUP BY generator)
SELECT lr.generator, lr.n, round(bl.bleu, 6) AS bleu, round(co.tf_cosine, 6) AS tf_cosine,
       round(lr.length_ratio, 6) AS length_ratio,
       (co.tf_cosine > {ACCEPT_SIMILARITY} AND bl.bleu > {ACCEPT_BLEU}
        AND lr.length_ratio BETWEEN {ACCEPT_RATIO[0]} AND {ACCEPT_RATIO[1]}) AS accepted
FROM lr JOIN bl ON lr.generator = bl.generator JOIN co ON lr.generator = co.generator""")
def q_eval_results(spark, sf_dir):
    return _results(spark, sf_dir, with_rouge=False)


@register("eval_results_full")
def q_eval_results_full(spark, sf_dir):
    """All metrics with ROUGE-L, from one join and one count per pair; one row per generator."""
    return _results(spark, sf_dir, with_rouge=True)


@register("prediction_matrix", sql=_with(_PREDS) + """
SELECT id, """ + ", ".join(
    f"max(CASE WHEN generator = '{g}' THEN length(prediction) END) AS {g}" for g in GENERATORS) + """
FROM preds GROUP BY id""")
def q_prediction_matrix(spark, sf_dir):
    p = predictions(spark, sf_dir).select("generator", "id", F.length("prediction").alias("len"))
    return p.groupBy("id").pivot("generator", list(GENERATORS)).agg(F.max("len"))
