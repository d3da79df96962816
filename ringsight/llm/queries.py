"""One query per operator, over the whole tables, and SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ringsight.llm import pieces, quality
from ringsight.llm.common import documents, held
from ringsight.llm.decontaminate import find_items
from ringsight.llm.grace_dedup import grace_dedup
from ringsight.llm.language_model import score_documents
from ringsight.llm.licenses import scan_licenses
from ringsight.llm.merkle import FIELDS, leaf_digest, merkle_manifest
from ringsight.llm.ngram_join import ngram_join
from ringsight.llm.pii import find_pii
from ringsight.llm.repair import damaged, repair_conversations
from ringsight.llm.repeats import find_repeats
from ringsight.llm.token_ids import read_token_files, write_token_files
from ringsight.llm.windows import remove_repeated_windows
from ringsight.session import materialize, prepare, shared_folder


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return score_documents(documents(spark, sf_dir))


def piece_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    encoded = pieces.encode(documents(spark, sf_dir), piece_model())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return find_repeats(documents(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return find_pii(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return find_items(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark")).drop("th")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    rows = materialize(quality.with_features(docs).select("doc_id", "x"), "document-features")
    scored = quality.scored_features(rows, quality.fit(rows, documents(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return scan_licenses(documents(spark, sf_dir))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "n_links", "n_grams")


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    prepare(spark)
    path = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write_token_files(documents(spark, sf_dir), path, str(public_tokenizers.path("word_bpe_49k.json")))
    return read_token_files(spark, path)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return grace_dedup(documents(spark, sf_dir))[0]


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table; those that lost all rows count zeros."""
    prepare(spark)
    rows = documents(spark, sf_dir, "conversations")
    found = repair_conversations(damaged(rows)).summary.withColumnRenamed("conv_id", "id")
    every = rows.select("conv_id").distinct()
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select("conv_id", *zeros, *texts)


def op12_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    left = remove_repeated_windows(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows picked by their ids have grown by one character since the manifest was made; a null id is never picked."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    picked = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    now = leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    found = merkle_manifest(docs, other=F.when(picked, now))
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_model": op1_language_model,
    "op2_pieces": op2_pieces,
    "op3_repeats": op3_repeats,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_ngram_join": op8_ngram_join,
    "op9_token_ids": op9_token_ids,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_repair": op11_repair,
    "op12_windows": op12_windows,
    "op13_manifest": op13_manifest,
}


def _crc32(text: str) -> str:
    """Unsigned crc32 of ASCII text, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, CAST(i AS INT), 1))::UBIGINT)"
    byte = "list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: k::UBIGINT)), lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {byte}), 4294967295::UBIGINT)"


def _leaf(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')" for x in fields) + ")"


def _halves(trees: str) -> str:
    """Every level of the binary trees over (grp, nodes)."""
    return f"""
        SELECT grp, 0 AS lev, nodes FROM {trees}
        UNION ALL
        SELECT grp, lev + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
        FROM THIS WHERE len(nodes) > 1
    """


#: The cheapest rest (cost, audit, repaired rows) from the states 0 nothing, 1 system, 2 user, 3 assistant, before the rows i to n.
def _edits() -> str:
    put = lambda cost, edit, row, rest: f"{{'c': {rest}.c + {cost}, 'a': '{edit}' || {rest}.a, 'r': list_prepend({row}, {rest}.r)}}"
    into = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    best = lambda options: f"list_sort([{', '.join(options)}])[1]"
    more = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"
    keeps, columns = "role || ':' || text", []
    for state, (to, name) in into.items():
        gone = f"{{'c': s{state}.c + 4, 'a': 'D' || s{state}.a, 'r': s{state}.r}}"
        rerole = put(f"3 + {more}", "R", f"'{name}:' || text", f"s{to}")
        keep = put(more, "K", keeps, f"s{to}")
        options = f"CASE WHEN fault IN ('blank', 'duplicate') THEN {gone} WHEN left(role, 1) = '{name[0]}' THEN {best([gone, rerole, keep])}"
        if state == 0:
            options += f" WHEN left(role, 1) = 's' THEN {best([gone, rerole, put(more, 'K', chr(39) * 0 + 'role || chr(58) || text', 's1')])}"
        columns.append(f"{options} ELSE {best([gone, rerole])} END AS t{state}")
    insert = {s: put(3, "I", f"'{name}:'", f"t{to}") for s, (to, name) in into.items()}
    first = f"SELECT conv_id, i, {best(['t2', insert[2]])} AS t2, {best(['t3', insert[3]])} AS t3, t0, t1 FROM d"
    return (
        f"SELECT conv_id, i, {best(['t0', insert[0]])} AS s0, {best(['t1', insert[1]])} AS s1, t2 AS s2, t3 AS s3 "
        f"FROM ({first.replace('FROM d', f'FROM (SELECT q.conv_id, q.i, {", ".join(columns)} FROM dp JOIN q ON q.conv_id IS NOT DISTINCT FROM dp.conv_id AND q.i = dp.i - 1)')})"
    )

ORACLE: dict[str, str] = {
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op11_repair": f"""
        WITH RECURSIVE o AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        f AS (SELECT *, {_crc32("name")} % 20 AS f FROM o),
        m AS (
            SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                   CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM f),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM m),
        q AS (
            SELECT conv_id, turn, role, text, i,
                   CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
            FROM n),
        dp AS (
            SELECT conv_id, max(i) + 1 AS i, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS s0,
                   {{'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s1, {{'c': 3, 'a': 'I', 'r': ['assistant:']}} AS s2,
                   {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS s3 FROM q GROUP BY conv_id
            UNION ALL {_edits()}),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM q GROUP BY conv_id),
        every AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost,
               coalesce(s0.a, '') AS audit, sha256(coalesce(array_to_string(s0.r, chr(10)), '')) AS repaired_sha256
        FROM every
        LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id
        LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM every.conv_id AND dp.i = 1
    """,
    "op12_windows": """
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        p AS (SELECT doc_id, len(w) AS n, w, unnest(range(1, len(w) + 1)) AS i FROM d),
        k AS (SELECT doc_id, i, n, w[i] AS word, CASE WHEN i + 19 <= n THEN md5(array_to_string(w[i:i + 19], ' ')) END AS k FROM p),
        r AS (SELECT *, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM k),
        g AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 19 PRECEDING) AS gone FROM r),
        s AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM g GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN s USING (doc_id)
    """,
    "op13_manifest": f"""
        WITH RECURSIVE l AS (
            SELECT doc_id, lang, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
                   CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS other
            FROM documents),
        n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
        g AS (SELECT lang AS grp, list(leaf ORDER BY pos) AS nodes FROM n GROUP BY lang),
        t AS ({_halves("g").replace("THIS", "t")}),
        sub AS (SELECT grp AS lang, nodes[1] AS subroot, row_number() OVER (ORDER BY grp IS NOT NULL, grp) - 1 AS pos FROM t WHERE len(nodes) = 1),
        h AS (SELECT 0 AS grp, list(subroot ORDER BY pos) AS nodes FROM sub),
        u AS ({_halves("h").replace("THIS", "u")}),
        x AS (
            SELECT n.*, sub.subroot, sub.pos AS place FROM n JOIN sub ON sub.lang IS NOT DISTINCT FROM n.lang),
        b AS (
            SELECT doc_id, leaf, x.lang, x.pos, lev, (x.pos >> lev) & 1 AS odd, coalesce(nodes[xor(x.pos >> lev, 1) + 1], '') AS sib
            FROM x JOIN t ON t.grp IS NOT DISTINCT FROM x.lang AND len(nodes) > 1
            UNION ALL
            SELECT doc_id, leaf, x.lang, x.pos, 100 + lev, (place >> lev) & 1, coalesce(nodes[xor(place >> lev, 1) + 1], '')
            FROM x JOIN u ON len(nodes) > 1),
        y AS (
            SELECT lang, pos, list(odd || sib ORDER BY lev) AS way, sha256(string_agg(sib, '' ORDER BY lev)) AS proof
            FROM b GROUP BY lang, pos),
        z AS (
            SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
                   list_reduce(list_prepend(coalesce(other, leaf), coalesce(way, [])),
                       lambda a, s: CASE WHEN s[1] = '1' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END) AS folded_root
            FROM x LEFT JOIN y ON y.lang IS NOT DISTINCT FROM x.lang AND y.pos = x.pos)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z
    """,
}
