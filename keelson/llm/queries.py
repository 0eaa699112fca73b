"""The registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import chat, hard_negatives, language_id, line_quality, minhash, mixing, packing, prefix_trie, simhash
from keelson.llm import suffix_dedup, token_counts, url_rules, vector_search
from keelson.llm.common import table

PACKING_TOKENIZER = "word_bpe_49k.json"
COUNTING_TOKENIZER = "piece_bpe_32k.model"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    return spans.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
        "kept_text",
    )


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_quality.judge(docs, line_quality.train(docs, table(spark, sf_dir, "labels")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.decided(table(spark, sf_dir, "documents"))
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def identified_documents(docs: DataFrame) -> DataFrame:
    model = language_id.fit(docs, "doc_id", "text", "lang")
    return language_id.identify(
        docs, model, text=F.col("text"), declared=F.col("lang"), host=F.col("source"), suffix=F.lit(None).cast("string")
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by its visible text, markup and address, and every document by its text, lang and source."""
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages")
    model = language_id.fit(docs, "doc_id", "text", "lang")
    of_pages = language_id.identify(
        pages, model, text=language_id.markup_text(F.col("html")), declared=language_id.markup_language(F.col("html")),
        host=url_rules.host(F.col("url")),
    )
    of_docs = identified_documents(docs)
    found = ("lang_id", "lang_confidence", F.col("lang_kept").alias("kept"))
    return of_docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), *found).union(
        of_pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", *found)
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTING_TOKENIZER))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    made = chat.format_chats(turns.union(told))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("segments"))
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    vectors = embeddings.select("vec_id", vector_search.whole(F.col("embedding")).alias("x")).filter("x is not null")
    return vector_search.search(vector_search.build(vectors), vectors.filter("vec_id % 20 = 0"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", moved.alias("label"), hard_negatives.whole(F.col("embedding")).alias("x"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_suffix_dedup, op3_line_quality, op4_mixing, op5_language_id, op6_token_counts, op7_simhash,
        op8_chat_format, op9_url_rules, op10_vector_search, op11_prefix_trie, op12_hard_negatives, op13_minhash, pipeline,
    )
}

#: Fixed values of op8: the template's strings, as SQL sees them.
_ESCAPED = "replace(replace({0}, '%', '%25'), '<|', '<%7C')"

ORACLE_SQL = {
    "op8_chat_format": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
            UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
        ), beside AS (
            SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM turns
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
                   AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                                          ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
               CAST(sum(CASE WHEN before = role THEN 11
                             ELSE 13 + length(replace({_ESCAPED.format("role")}, chr(10), '%0A')) END
                        + length({_ESCAPED.format("text")})
                        + CASE WHEN after = role THEN 0 ELSE 11 END) AS BIGINT) AS formatted_chars
        FROM beside GROUP BY conv_id""",
    "op10_vector_search": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT vec_id, unnest(x) AS v, unnest(range(len(x))) AS i FROM vectors
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
            FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.vec_id
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
    # CRC-32 bit by bit; a node is its list of turns, and its subtree all nodes whose list begins with it.
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS j
            FROM conversations WHERE conv_id IS NOT NULL
        ), names AS (
            SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM turns
        ), bits AS (
            SELECT conv_id, list_transform(range(8 * length(s)),
                                           lambda i: (ascii(s[i // 8 + 1]) >> CAST(i % 8 AS INTEGER)) & 1) AS bits FROM names
        ), families AS (
            SELECT conv_id, conv_id - conv_id % 20 AS giver,
                   xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(bits, lambda b: CAST(b AS BIGINT))),
                                   lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 4 AS h
            FROM bits
        ), steps AS (
            SELECT f.conv_id, 0 AS kind, j, role, text FROM families f JOIN turns t ON t.conv_id = f.giver AND j <= h
            UNION ALL
            SELECT f.conv_id, 1, j, role, text FROM families f JOIN turns t ON t.conv_id = f.conv_id AND j > h
        ), rows AS (
            SELECT conv_id, row_number() OVER w AS depth, list(md5(role) || md5(text)) OVER w AS path,
                   len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS words
            FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY kind, j)
            UNION ALL SELECT conv_id, 0, [], 0 FROM families
        ), lengths AS (SELECT conv_id, max(depth) AS n FROM rows GROUP BY conv_id
        ), nodes AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
                   sha256(coalesce(string_agg(CASE WHEN depth = n THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), ''))
                       AS ends_sha256
            FROM rows JOIN lengths USING (conv_id) GROUP BY path, depth
        ), edges AS (
            SELECT c.path, p.path AS parent, p.conv_id AS parent_conv_id
            FROM nodes c JOIN nodes p ON c.depth = p.depth + 1 AND c.path[1:p.depth] = p.path
        ), children AS (SELECT parent AS path, count(*) AS n_children FROM edges GROUP BY parent
        ), own AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
        ), below AS (
            SELECT path[1:a] AS path, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
                   CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM own) GROUP BY 1
        )
        SELECT own.conv_id, own.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM own JOIN below USING (path) LEFT JOIN edges USING (path)""",
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT vec_id, label, unnest(x) AS v, unnest(range(len(x))) AS i FROM vectors
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(sum(a.v * c.v) AS BIGINT) AS score
            FROM parts a JOIN parts c ON a.i = c.i AND a.vec_id <> c.vec_id
            WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, c.vec_id, a.label, c.label
        ), firsts AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT f.anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY f.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM firsts f JOIN scored s ON s.anchor_id = f.anchor_id AND NOT alike
             AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY row_number() OVER (PARTITION BY f.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
    # Every pair of sets that share a shingle, counted; components by reachability.
    "op13_minhash": """
        WITH words AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^ \\t\\n\\x0B\\f\\r]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
            FROM words
        ), members AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.m = b.m AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), reach AS (
            WITH RECURSIVE r AS (
                SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM r JOIN links l ON l.a = r.other
            ) SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
        FROM sets s JOIN reach USING (doc_id)""",
}


def _url_oracle() -> str:
    """Every rule against every url. Of the matches: host rules first, then the longest name, then the first."""

    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    host = "regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for r in url_rules.HOST_RULES:  # by the contract's words: host or subdomain, and the path starts with the rule's
        rule_host, _, rest = r.name.partition("/")
        fits = (
            f"(host = {text(rule_host)} OR ends_with(host, {text('.' + rule_host)})) "
            f"AND starts_with(path, {text('/' + rest)})"
        )
        rows.append((r, fits))
    for r in url_rules.GENERAL_RULES:
        rows.append((r, f"regexp_matches(host || rest, {text(r.pattern)})"))
    rows.sort(key=lambda x: (x[0].rank, -len(x[0].name), x[0].name))
    name = " ".join(f"WHEN {fits} THEN {text(r.name)}" for r, fits in rows)
    rule = " ".join(f"WHEN matched = {text(r.name)} THEN {text(r.name)}" for r, _ in rows if r.rank == 0)
    verdict = " ".join(f"WHEN matched = {text(r.name)} THEN {text(r.action)}" for r, _ in rows)
    return f"""
        WITH parts AS (
            SELECT page_id, translate({host}, '{upper}', '{lower}') AS host,
                   regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
                   regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*((?s:.*))$', 1) AS rest
            FROM pages
        ), named AS (SELECT *, CASE {name} END AS matched FROM parts)
        SELECT page_id, host, path, CASE {rule} END AS rule, matched,
               CASE {verdict} ELSE 'allow' END AS verdict
        FROM named"""


ORACLE_SQL["op9_url_rules"] = _url_oracle()

#: Words, hashes and order as mixing.decided has them; the order sample by one running sum per source.
ORACLE_SQL["op4_mixing"] = f"""
    WITH d AS (
        SELECT doc_id, source,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS size
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
        FROM d GROUP BY source
    ), w AS (
        SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS cap FROM s
    ), levels AS (
        SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                   - (sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap))
                  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM w
    ), t AS (
        SELECT *, least(cap::DOUBLE, coalesce(weight * (SELECT level FROM levels WHERE level * weight <= cap
                                                         ORDER BY cap / weight, source NULLS LAST LIMIT 1),
                                              cap::DOUBLE)) AS target
        FROM levels
    ), f AS (
        SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS factor FROM t
    ), p AS (
        SELECT d.doc_id, d.source, d.size, f.source_size, f.target, floor(factor) AS whole,
               target - floor(factor) * source_size AS "left", CAST(floor(sqrt(size)) AS BIGINT) + 1 AS pull,
               (CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)
                + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
        FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
    ), pulls AS (
        -- If all documents with a larger pull are certain, what is left for those up to this one?
        SELECT source, pull, "left" - coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY pull
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS room,
               sum(sum(size * pull)) OVER (PARTITION BY source ORDER BY pull)::DOUBLE AS weighted
        FROM p WHERE size > 0 GROUP BY source, pull, "left"
    ), odds AS (
        SELECT source, max(pull) AS "limit", arg_max(room, pull) AS room, arg_max(room / weighted, pull) AS odds
        FROM pulls WHERE room * pull < weighted GROUP BY source
    ), q AS (
        SELECT p.*, odds.room, CASE WHEN pull <= "limit" AND odds > 0
                                    THEN u / (1 - u) * (1 - odds * pull) / (odds * pull) END AS q
        FROM p LEFT JOIN odds ON p.source IS NOT DISTINCT FROM odds.source
    ), r AS (
        -- Certain documents have no q; their peers are not ranked.
        SELECT *, sum(CASE WHEN q IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY q NULLS LAST, u, doc_id)
                      AS run,
               sum(size) OVER (PARTITION BY source, q, u, doc_id) AS same
        FROM q
    )
    SELECT doc_id, size, source_size, target,
           CAST(size * (whole + CASE WHEN "left" <= 0 OR size = 0 THEN 0
                                     WHEN q IS NULL THEN 1
                                     WHEN run - room <= room - (run - same) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM r"""
