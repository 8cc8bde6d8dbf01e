"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratemark.llm import (
    bpe,
    chat,
    decontaminate,
    fingerprints,
    htmltext,
    linededup,
    merkle,
    mixing,
    resampling,
    simhash,
    substrings,
    tokencounts,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are for measuring only."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, with_counts=True)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP4 = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    wins AS (
      SELECT DISTINCT item_id, array_to_string(list_slice(w, pos, pos + 9), ' ') AS win, least(len(w), 10) AS n
      FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS pos FROM i WHERE len(w) > 0)
    ),
    places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d),
    hits AS (
      SELECT p.doc_id, p.pos, n, item_id
      FROM (SELECT doc_id, pos, m.n AS size, array_to_string(list_slice(w, pos, pos + m.n - 1), ' ') AS win
            FROM places, (SELECT DISTINCT n FROM wins) AS m
            WHERE pos + m.n - 1 <= len(w)) AS p
      JOIN wins ON p.win = wins.win AND p.size = wins.n
    ),
    words AS (
      SELECT doc_id, count(DISTINCT word) AS n_hit
      FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id
    ),
    items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
      CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


# A public byte-level vocabulary; its next free id ends documents.
VOCABULARY = os.environ.get("TOKENIZER_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
END_OF_DOCUMENT = 50256


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return tokencounts.token_counts(docs, VOCABULARY, END_OF_DOCUMENT)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(_table(spark, sf_dir, "documents"), split_equal=True)
    return plan.withColumn("taken", F.col("copies") * F.col("size"))


def _mix_round(n: int, before: str) -> str:
    """Documents that round ``n`` of the filling takes, and what room is left."""
    return f"""p{n} AS (
      SELECT *, coalesce(open AND size <= room AND sum(CASE WHEN open AND size <= room THEN size END)
          OVER (PARTITION BY source ORDER BY NOT (open AND size <= room), rank, draw, nth) <= room,
        FALSE) AS hit FROM {before}
    ), r{n} AS (
      SELECT * EXCLUDE (hit, drawn, open, room), drawn OR hit AS drawn, open AND NOT hit AS open,
        room - coalesce(sum(CASE WHEN hit THEN size END) OVER (PARTITION BY source), 0) AS room
      FROM p{n}
    )"""


_OP8 = rf"""WITH d AS (
      SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')) AS draw,
        row_number() OVER () AS nth
      FROM documents
    ), s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
    ), w AS (
      SELECT *, 3 * source_size AS most, CAST(list_extract([5, 2, 1], CAST(
        (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)) AS DOUBLE) AS weight
      FROM s
    ), f AS (
      SELECT *, most / weight AS full_at, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM w
    ), c AS (
      SELECT *, sum(most) OVER (ORDER BY full_at)
        + full_at * (sum(weight) OVER () - sum(weight) OVER (ORDER BY full_at)) <= total AS capped
      FROM f
    ), t AS (
      SELECT source, source_size, CASE WHEN capped THEN CAST(most AS DOUBLE) ELSE
        weight * CAST(total - coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0) AS DOUBLE)
        / sum(CASE WHEN NOT capped THEN weight END) OVER () END AS target
      FROM c
    ), e AS (
      SELECT d.*, source_size, target,
        CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0 END AS expected,
        (CAST('0x' || substr(draw, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), o AS (
      SELECT *, CAST(floor(expected) AS BIGINT) AS whole,
        greatest(1e-9, least(1 - 1e-9, expected - floor(expected))) AS part FROM e
    ), q AS (
      SELECT *, (u / (1 - u)) / (part / (1 - part)) AS rank, FALSE AS drawn, expected > whole AS open,
        greatest(0, target - sum(whole * size) OVER (PARTITION BY source)) AS room FROM o
    ), {_mix_round(0, 'q')}, {_mix_round(1, 'r0')}, {_mix_round(2, 'r1')}
    SELECT doc_id, size, source_size, target, whole + CAST(drawn AS BIGINT) AS copies,
      (whole + CAST(drawn AS BIGINT)) * size AS taken FROM r2"""


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_with_edits(_table(spark, sf_dir, "documents"))


# A conversation that speaks in control strings of another template.
_CONTROL_TALK = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql(
        "SELECT conv_id, turn, role, text FROM VALUES (-1L, 0L, 'user', :said),"
        " (-1L, 1L, 'assistant', :said) AS t(conv_id, turn, role, text)",
        args={"said": _CONTROL_TALK},
    )
    done = chat.format_conversations(turns.unionByName(more)).withColumns(
        {
            "turns": chat.read_turns(F.col("formatted")),
            "learned": chat.read_spans(F.col("formatted"), F.col("loss_spans")),
        }
    )
    said = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESCAPED = (
    "regexp_replace({}, '" + chat.ESCAPE.replace("'", "''") + r"', '\1\\\2\3', 'g')"
)

_OP10 = f"""WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations
      UNION ALL
      SELECT -1, turn, role, '{_CONTROL_TALK}'
      FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
    ), e AS (
      SELECT *, length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})
        + {len(chat.TURN + chat.SAYS + chat.END)} AS size FROM t
    ), g AS (
      SELECT conv_id, count(*) AS n_turns, sum(size) AS size,
        string_agg(role || chr(10) || text || chr(10), ''
                   ORDER BY turn NULLS FIRST, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                 FILTER (role = 'assistant'), '') AS learned
      FROM e GROUP BY conv_id
    )
    SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
      CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
      CAST(size AS BIGINT) AS formatted_chars FROM g"""


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resampled(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# The 256 steps of CRC32 by their rule, and the checksum of a binary: its bytes
# taken in one after the other.
_CRC_STEPS = """(SELECT list_transform(range(256), lambda n: list_reduce(range(8),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n))::BIGINT[] AS steps)"""


def _crc_sql(binary: str) -> str:
    return f"""xor(4294967295::BIGINT, list_reduce(
      list_transform(range(octet_length({binary})),
        lambda i: CAST('0x' || substr(hex({binary}), 2 * i::BIGINT + 1, 2) AS BIGINT)),
      lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295::BIGINT))"""


_OP11 = f"""WITH crc AS MATERIALIZED {_CRC_STEPS},
    d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
    dw AS (SELECT row, unnest(w) AS word FROM d),
    tw AS (SELECT unnest(w) AS word FROM (SELECT {_WORDS} AS w FROM benchmark)),
    b AS MATERIALIZED (
      SELECT word, {_crc_sql('encode(word)')} % 10000 AS bucket
      FROM (SELECT word FROM dw UNION SELECT word FROM tw), crc
    ),
    s AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM tw JOIN b USING (word) GROUP BY bucket),
    g AS (
      SELECT bucket, CAST(floor(1000 * ln(
          (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
          / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)
        )) AS BIGINT) AS gain
      FROM s FULL JOIN t USING (bucket)
    ),
    f AS (
      SELECT row, count(*) AS n, sum(gain) AS gained
      FROM dw JOIN b USING (word) JOIN g USING (bucket) GROUP BY row
    ),
    v AS (
      SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
        CAST(coalesce(floor(gained::DOUBLE / n), 0) AS BIGINT) AS weight,
        CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN f USING (row)
    ),
    e AS (
      SELECT doc_id, n_features, weight,
        weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM v
    ),
    o AS (
      SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS FIRST) AS place FROM e
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <=
        (SELECT count(*) FROM e WHERE n_features >= 20) * 10 // 100 THEN place END AS rank FROM o"""


# A public vocabulary whose words have ends; a path that all executors can open.
WORD_VOCABULARY = os.environ.get("TOKENIZER_WORDS", "/opt/tokenizers/word_bpe_49k.json")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.encoded(_table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return bpe.decoded(tokens, WORD_VOCABULARY).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(*merkle.COLUMNS)
    values = [F.translate("text", "\n", "") if c == "text" else F.col(c) for c in merkle.COLUMNS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered, merkle.leaf_digest(*values))
    found = merkle.manifest(docs.withColumn("changed", changed), keep=("changed",))
    rebuilt = merkle.folded(
        F.coalesce("changed", "leaf"), F.col("proof"), F.col("places"), F.col("sizes")
    )
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        rebuilt.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values
    ) + ")"


def _levels_sql(base: str) -> str:
    """Nodes of all levels, from those of ``base`` (tree, place, n, digest)."""
    return f"""SELECT tree, 0 AS level, place, n, digest FROM {base}
      UNION ALL
      SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
      FROM {{}} WHERE n > 1 GROUP BY tree, level, n, place // 3"""


_OP13 = f"""WITH RECURSIVE crc AS MATERIALIZED {_CRC_STEPS},
    h AS (
      SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
        CASE WHEN {_crc_sql('encode(doc_id::VARCHAR)')} % 2 = 0
          THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed
      FROM documents, crc
    ),
    l AS MATERIALIZED (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS row FROM h
    ),
    lower AS ({_levels_sql('(SELECT source AS tree, place, n, leaf AS digest FROM l)').format('lower')}),
    subs AS MATERIALIZED (
      SELECT tree AS source, level AS height, digest AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place,
        count(*) OVER () AS n FROM lower WHERE n = 1
    ),
    upper AS ({_levels_sql('(SELECT 0 AS tree, place, n, subroot AS digest FROM subs)').format('upper')}),
    nodes AS MATERIALIZED (
      SELECT tree, FALSE AS above, level, place, digest FROM lower WHERE n > 1
      UNION ALL SELECT NULL, TRUE, level, place, digest FROM upper WHERE n > 1
    ),
    path AS (
      SELECT row, l.source, subs.place AS nth, height, l.place, 0 AS level, height = 0 AS above,
        CASE WHEN height = 0 THEN subs.place ELSE l.place END AS here,
        coalesce(changed, leaf) AS digest, '' AS proof
      FROM l JOIN subs ON l.source IS NOT DISTINCT FROM subs.source
      UNION ALL
      SELECT row, source, nth, height, place, next, ended, CASE WHEN ended AND NOT above THEN nth ELSE here END, digest, proof FROM (
        SELECT p.row, p.source, p.nth, p.height, p.place, p.above,
          p.above OR p.level + 1 = p.height AS ended,
          CASE WHEN NOT p.above AND p.level + 1 = p.height THEN 0 ELSE p.level + 1 END AS next,
          p.here // 3 AS here,
          sha256(string_agg(CASE WHEN x.place = p.here THEN p.digest ELSE x.digest END, '' ORDER BY x.place)) AS digest,
          p.proof || coalesce(string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place <> p.here), '') AS proof
        FROM path AS p JOIN nodes AS x
          ON x.above = p.above AND (p.above OR x.tree IS NOT DISTINCT FROM p.source)
          AND x.level = p.level AND x.place // 3 = p.here // 3
        GROUP BY p.row, p.source, p.nth, p.height, p.place, p.above, p.level, p.here, p.proof
      ) AS s
    ),
    done AS (SELECT row, arg_max(digest, (above, level)) AS folded_root, arg_max(proof, (above, level)) AS proof FROM path GROUP BY row),
    root AS (SELECT digest AS root FROM upper WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM l JOIN done USING (row) JOIN subs ON l.source IS NOT DISTINCT FROM subs.source, root"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_html_text": op2_html_text,
        "op3_line_dedup": op3_line_dedup,
        "op4_decontamination": op4_decontamination,
        "op5_simhash": op5_simhash,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_token_counts": op7_token_counts,
        "op8_source_mix": op8_source_mix,
        "op9_fingerprints": op9_fingerprints,
        "op10_chat_format": op10_chat_format,
        "op11_resampling": op11_resampling,
        "op12_bpe": op12_bpe,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": _OP4,
        "op8_source_mix": _OP8,
        "op10_chat_format": _OP10,
        "op11_resampling": _OP11,
        "op13_merkle": _OP13,
    }
