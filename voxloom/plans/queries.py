"""Queries over the driver's tables, each beside the SQL that says what it returns.

The tables stand in for speech data: events are turns (user = file, type =
speaker), conversations are utterances, embeddings are waveforms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import prompts, relational, samples, sequences, waveform

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL if there is any."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def turns(spark, sf) -> DataFrame:
    """file, seq, st, en, spk of events."""
    st = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    out = table(spark, sf, "events").select(F.col("user_id").alias("file"), F.col("event_id").alias("seq"), st.alias("st"), (st + F.col("value") * 60).alias("en"), F.col("event_type").alias("spk"))
    return out.where("en > st")


TURNS = """turns AS (SELECT * FROM (
  SELECT user_id AS file, event_id AS seq, epoch_us(ts) / 1e6 AS st, epoch_us(ts) / 1e6 + value * 60 AS en, event_type AS spk FROM events
) WHERE en > st), o AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY st, en, seq) AS rn FROM turns
)"""


def utterances(spark, sf) -> DataFrame:
    """file, idx, st, en, spk, text: conversations cut at commas, 15 characters to the second."""
    parts = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", ", ")).alias("p", "text"))
    w = Window.partitionBy("conv_id").orderBy("turn", "p")
    end = F.sum(F.length("text")).over(w)
    return parts.select(F.col("conv_id").alias("file"), (F.row_number().over(w) - 1).alias("idx"), ((end - F.length("text")) / 15.0).alias("st"), (end / 15.0).alias("en"), F.col("role").alias("spk"), "text")


UTTERANCES = r"""parts AS (
  SELECT conv_id, turn, role, unnest(string_split(text, ', ')) AS text, generate_subscripts(string_split(text, ', '), 1) AS p FROM conversations
), utts AS (
  SELECT conv_id AS file, row_number() OVER w - 1 AS idx, (sum(length(text)) OVER w - length(text)) / 15.0::DOUBLE AS st, (sum(length(text)) OVER w) / 15.0::DOUBLE AS en, role AS spk, text
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY turn, p ROWS UNBOUNDED PRECEDING)
)"""


# --- text


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s FROM documents),
m AS (SELECT doc_id, string_split(regexp_replace(s, '([.?!])\s+([a-zæøåäöü])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS x FROM t)
SELECT doc_id, array_to_string(list_transform(x, lambda p: upper(p[1]) || p[2:]), ' ') AS text FROM m""")
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.normalize_text("text").alias("text"))


@query(r"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)) AS x FROM documents)
SELECT doc_id, generate_subscripts(x, 1)::BIGINT - 1 AS pos, unnest(x) AS sentence FROM s""")
def sentence_tokenize(spark, sf):
    out = table(spark, sf, "documents").select("doc_id", F.posexplode(T.sentences("text")).alias("pos", "sentence"))
    return out.withColumn("pos", F.col("pos").cast("long"))


@query(r"SELECT conv_id, turn, regexp_matches(text, '[.?!]\s*$') AS ended FROM conversations UNION ALL SELECT doc_id, -1, regexp_matches(text, '[.?!]\s*$') FROM documents")
def ends_with_punct(spark, sf):
    a = table(spark, sf, "conversations").select("conv_id", "turn", T.ends_sentence("text").alias("ended"))
    return a.unionAll(table(spark, sf, "documents").select("doc_id", F.lit(-1).cast("long"), T.ends_sentence("text")))


@query("SELECT event_id, printf('chunk_%05d_%s', user_id, event_type) AS raw, event_type AS canonical, event_type || ': ' AS prefix FROM events")
def canonical_speaker(spark, sf):
    raw = F.format_string("chunk_%05d_%s", "user_id", "event_type")
    e = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return e.select("event_id", "raw", T.canonical_speaker("raw").alias("canonical"), T.speaker_prefix(T.canonical_speaker("raw")).alias("prefix"))


@query(r"""WITH b AS (SELECT page_id, string_split(url, '/')[-1] AS base FROM pages)
SELECT page_id, base, CASE WHEN regexp_matches(base, '.\.[^.]*$') THEN regexp_replace(base, '\.[^.]*$', '') ELSE base END AS stem,
  lower(regexp_extract(base, '.(\.[^.]*)$', 1)) AS suffix, CASE WHEN base NOT IN ('', '.') THEN base ELSE printf('sample_%06d.wav', page_id) END AS name, printf('%s_utt_%05d__spk__%s.wav', base, page_id, 'a') AS clip, page_id AS parsed FROM b""")
def file_stem_name(spark, sf):
    p = table(spark, sf, "pages")
    clip = T.clip_name(T.base_name("url"), "page_id", F.lit("a"))
    out = p.select("page_id", T.base_name("url").alias("base"), T.stem("url").alias("stem"), T.suffix("url").alias("suffix"), T.file_name(F.col("url"), "sample", "page_id").alias("name"), clip.alias("clip"))
    return out.withColumn("parsed", T.utterance_index("clip").cast("long"))


@query("""SELECT conv_id, turn, CASE WHEN starts_with(trim(text), 'Speaker ') THEN trim(text) WHEN role <> 'system' THEN trim(role || ': ' || trim(text)) ELSE trim('Speaker 0: ' || trim(text)) END AS text FROM conversations""")
def item_format(spark, sf):
    speaker = F.when(F.col("role") != "system", F.col("role")).otherwise("")
    return table(spark, sf, "conversations").select("conv_id", "turn", T.item_text("text", speaker).alias("text"))


@query("SELECT page_id, replace(url, '/', '_') || '_data' AS name, page_id + 3.0::DOUBLE + page_id % 7 AS total FROM pages")
def display_and_numbers(spark, sf):
    lists = F.format_string("%d, 2.5,%d.5", "page_id", F.col("page_id") % 7)
    total = F.aggregate(T.numbers(lists), F.lit(0.0), lambda a, x: a + x)
    return table(spark, sf, "pages").select("page_id", T.display_name(F.array(F.col("url"), F.lit("/x/data/"))).alias("name"), total.alias("total"))


# --- filters, aggregates, joins, sets


def durations(spark, sf) -> DataFrame:
    """n_chars at 15 characters to the second, as whole hundredths: exact sums."""
    return table(spark, sf, "documents").select("doc_id", "source", (F.col("n_chars") / 16.0).alias("duration"))


@query("SELECT count(*) AS n, sum(d) AS total, sum(d) / 3600 AS hours, min(d) AS min, max(d) AS max, sum(d) / count(*) AS mean FROM (SELECT n_chars / 16.0::DOUBLE AS d FROM documents) WHERE d BETWEEN 3 AND 1000")
def duration_stats(spark, sf):
    return relational.duration_stats(relational.within(durations(spark, sf), "duration", 3, 1000))


@query("""WITH d AS (SELECT n_chars / 16.0::DOUBLE AS x FROM documents), b AS (SELECT min(x) AS lo, max(x) AS hi FROM d),
c AS (SELECT least(floor((x - lo) / ((hi - lo) / 100)), 99)::INTEGER AS bin, count(*) AS n FROM d, b GROUP BY 1)
SELECT g.bin::INTEGER AS bin, lo + g.bin * ((hi - lo) / 100) AS low, lo + (g.bin + 1) * ((hi - lo) / 100) AS high, coalesce(n, 0) AS n FROM range(100) g(bin) CROSS JOIN b LEFT JOIN c USING (bin)""")
def duration_histogram(spark, sf):
    return relational.histogram(durations(spark, sf))


def records(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.count_distinct("role").alias("num_speakers"), F.count("*").alias("turns"))


RECORDS = "records AS (SELECT conv_id, count(DISTINCT role) AS num_speakers, count(*) AS turns FROM conversations GROUP BY conv_id)"


@query(f"WITH {RECORDS} SELECT * FROM records WHERE num_speakers <= 2")
def speaker_count_filter(spark, sf):
    return relational.at_most_speakers(records(spark, sf), 2)


@query(f"WITH {RECORDS} SELECT count(*) AS total, count(*) FILTER (num_speakers = 1) AS single, count(*) - count(*) FILTER (num_speakers = 1) AS multi FROM records")
def single_multi_counts(spark, sf):
    return relational.count_single_multi(records(spark, sf))


@query(f"WITH {RECORDS} SELECT conv_id, 'single' AS part FROM records WHERE num_speakers = 1 UNION ALL SELECT conv_id, 'multi' FROM records WHERE num_speakers > 1")
def single_multi_split(spark, sf):
    a, b = relational.single_and_multi(records(spark, sf))
    return a.select("conv_id", F.lit("single").alias("part")).unionAll(b.select("conv_id", F.lit("multi")))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def first_seen_distinct(spark, sf):
    return relational.first_seen(table(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id")


@query("SELECT event_id, user_id FROM events WHERE value <= 100 ORDER BY event_id LIMIT 25")
def first_n(spark, sf):
    return relational.first_n(table(spark, sf, "events").where("value <= 100").select("event_id", "user_id"), 25, "event_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_semi(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")


@query("SELECT d.doc_id, coalesce(l.quality::DOUBLE, d.n_chars / 16.0) AS value, l.doc_id IS NOT NULL AS probed FROM documents d LEFT JOIN labels l USING (doc_id)")
def metadata_fallback(spark, sf):
    d, l = durations(spark, sf), table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("q"))
    return d.join(l, "doc_id", "left").select("doc_id", F.coalesce("q", "duration").alias("value"), F.col("q").isNotNull().alias("probed"))


@query("SELECT u.doc_id, u.text, e.n FROM (SELECT doc_id, source AS text FROM documents WHERE n_chars > 100) u JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY doc_id) e USING (doc_id)")
def transcript_join(spark, sf):
    u = table(spark, sf, "documents").where("n_chars > 100").select("doc_id", F.col("source").alias("text"))
    return u.join(table(spark, sf, "labels").groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id")


@query("SELECT doc_id, lang, NULL::BIGINT AS n_chars, 0 AS _src FROM documents WHERE source = 'src1' UNION ALL SELECT doc_id, NULL, n_chars, 1 FROM documents WHERE source = 'src2'")
def merge_datasets(spark, sf):
    d = table(spark, sf, "documents")
    return relational.merge_datasets([d.where("source = 'src1'").select("doc_id", "lang"), d.where("source = 'src2'").select("doc_id", "n_chars")])


@query("SELECT doc_id, source, n_chars, 0 AS _src FROM documents WHERE source = 'src0' UNION ALL SELECT doc_id, source, n_chars, 1 FROM documents WHERE source = 'src1' UNION ALL SELECT doc_id, source, n_chars, 2 FROM documents WHERE source = 'src2'")
def union_splits(spark, sf):
    """All splits of a dataset as one, each by itself."""
    d = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return relational.union_all([d.where(F.col("source") == s) for s in ("src0", "src1", "src2")])


@query("""WITH c AS (SELECT (row_number() OVER (ORDER BY i, j, k) - 1)::INTEGER AS combo, n AS nfe, l AS lambd, t AS tau FROM
  (SELECT unnest([16, 32, 64]) AS n, unnest([0, 1, 2]) AS i), (SELECT unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS l, unnest([0, 1, 2]) AS j), (SELECT unnest([0.0, 0.5, 1.0]::DOUBLE[]) AS t, unnest([0, 1, 2]) AS k))
SELECT combo, nfe, lambd, tau, count(*) AS n, max(value) AS longest FROM c JOIN events e ON e.event_id % 27 = c.combo GROUP BY GROUPING SETS ((combo, nfe, lambd, tau), ())""")
def param_sweep(spark, sf):
    c = relational.sweep(spark, [16, 32, 64], [0.1, 0.5, 0.9], [0.0, 0.5, 1.0])
    e = table(spark, sf, "events").select((F.col("event_id") % 27).cast("int").alias("combo"), "value")
    keys = [F.col(k) for k in ("combo", "nfe", "lambd", "tau")]
    return e.join(F.broadcast(c), "combo").groupingSets([keys, []], *keys).agg(F.count("*").alias("n"), F.max("value").alias("longest"))


@query("""WITH e AS (SELECT (event_id % 7) / 8.0::DOUBLE AS t, (event_id % 5)::DOUBLE AS a FROM events), s AS (SELECT sum(t) AS t, sum(a) AS a, count(*) AS n FROM e)
SELECT 0.0::DOUBLE AS t_load, 0.0::DOUBLE AS t_denoise, t AS t_enhance, 0.0::DOUBLE AS t_save, t AS t_total, a AS audio_duration, n AS n_files, t / n AS avg_total, t / a AS rtf FROM s""")
def timing_rollup(spark, sf):
    t = (F.col("event_id") % 7) / 8.0
    zero = [F.lit(0.0).alias(c) for c in ("t_load", "t_denoise", "t_save")]
    return relational.real_time_factor(table(spark, sf, "events").select(*zero, t.alias("t_enhance"), t.alias("t_total"), (F.col("event_id") % 5).cast("double").alias("audio_duration")))


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS types FROM events GROUP BY user_id")
def group_to_list(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("x"))
    return rows.select("user_id", F.array_join(F.transform("x", lambda x: x["event_type"]), ",").alias("types"))


@query("SELECT user_id, array_to_string(list_filter(list(event_type ORDER BY event_id), lambda x: x NOT IN ('click', 'view')), ',') AS types FROM events GROUP BY user_id")
def exclusion_filter(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]).alias("x"))
    return rows.select("user_id", F.array_join(relational.without(F.col("x"), F.array(F.lit("click"), F.lit("view"))), ",").alias("types"))


# --- intervals


def chunked(df: DataFrame) -> DataFrame:
    """Turns as three chunks in turn would name their speakers."""
    at = (F.col("seq") % 3).cast("int")
    return df.withColumns({"spk": F.format_string("chunk_%05d_%s", at, F.col("spk")), "chunk_index": at})


def source_columns(df: DataFrame) -> DataFrame:
    """The lists of sources as text."""
    speakers, chunks = F.array_join("source_speaker_ids", ","), F.array_join(F.transform("source_chunk_indices", lambda x: x.cast("string")), ",")
    return df.withColumns({"speakers": speakers, "chunks": chunks}).drop("source_speaker_ids", "source_chunk_indices")


SOURCES = """CASE WHEN min(seq % 3) = max(seq % 3) THEN min(seq % 3)::INTEGER END AS chunk_index, string_agg(printf('chunk_%05d_%s', seq % 3, spk), ',' ORDER BY rn) AS speakers, string_agg((seq % 3)::VARCHAR, ',' ORDER BY rn) AS chunks"""


@query(f"""WITH {TURNS}, r AS (SELECT *, CASE WHEN lag(spk) OVER w IS NOT DISTINCT FROM spk THEN 0 ELSE 1 END AS b FROM o WINDOW w AS (PARTITION BY file ORDER BY rn)),
s AS (SELECT *, sum(b) OVER (PARTITION BY file ORDER BY rn) AS run FROM r),
g AS (SELECT *, CASE WHEN st - max(en) OVER (PARTITION BY file, run ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 3600.0 THEN 0 ELSE 1 END AS c FROM s),
i AS (SELECT *, sum(c) OVER (PARTITION BY file ORDER BY rn) AS island FROM g)
SELECT file, (island - 1)::INTEGER AS idx, min(st) AS st, max(en) AS en, min(spk) AS spk, count(*) AS n, {SOURCES} FROM i GROUP BY file, island""")
def merge_adjacent(spark, sf):
    return source_columns(sequences.merge_adjacent(chunked(turns(spark, sf)), 3600.0))


@query(f"""WITH RECURSIVE {TURNS}, f AS (
  SELECT file, rn, 0 AS idx, st, en, spk, 1::BIGINT AS n FROM o WHERE rn = 1
  UNION ALL
  SELECT file, rn, CASE WHEN j THEN idx ELSE idx + 1 END, CASE WHEN j THEN st ELSE ost END, CASE WHEN j THEN greatest(en, oen) ELSE oen END, ospk, CASE WHEN j THEN n + 1 ELSE 1 END FROM (
    SELECT f.file, o.rn, f.idx, f.st, f.en, f.n, o.st AS ost, o.en AS oen, o.spk AS ospk, o.spk = f.spk AND o.st - f.en <= 3600.0 AND greatest(f.en, o.en) - f.st <= 20000.0 AS j
    FROM f JOIN o ON o.file = f.file AND o.rn = f.rn + 1)),
m AS (SELECT file, idx, st, en, spk, n FROM f QUALIFY row_number() OVER (PARTITION BY file, idx ORDER BY rn DESC) = 1),
c AS (SELECT file, idx, {SOURCES} FROM (SELECT f.file, f.idx, o.rn, o.seq, o.spk FROM f JOIN o USING (file, rn)) GROUP BY file, idx)
SELECT * FROM m JOIN c USING (file, idx)""")
def merge_adjacent_capped(spark, sf):
    return source_columns(sequences.merge_adjacent_capped(chunked(turns(spark, sf)), 3600.0, 20000.0))


@query(f"""WITH {TURNS}, p AS (SELECT file, seq, st, en, spk, unnest(range(0, greatest(ceil((en - st) / 5000.0::DOUBLE)::BIGINT, 1))) AS i FROM o)
SELECT file, seq, st + i * 5000.0::DOUBLE AS st, least(st + i * 5000.0::DOUBLE + 5000.0::DOUBLE, en) AS en, spk, i::INTEGER AS piece FROM p""")
def cap_durations(spark, sf):
    return sequences.cap_durations(turns(spark, sf), 5000.0)


@query(f"""WITH RECURSIVE {TURNS}, l AS (SELECT *, lead(st) OVER w AS lst, lead(en) OVER w AS len, lead(spk) OVER w AS lspk FROM o WINDOW w AS (PARTITION BY file ORDER BY rn)), f AS (
  SELECT DISTINCT file, 0::BIGINT AS rn, -1 AS idx, NULL::DOUBLE AS st, NULL::DOUBLE AS en, NULL::VARCHAR AS spk, NULL::DOUBLE AS nst, false AS skip FROM o
  UNION ALL
  SELECT file, rn, CASE WHEN k = 'push' THEN idx + 1 ELSE idx END, CASE WHEN k = 'push' THEN s ELSE st END,
    CASE k WHEN 'push' THEN oen WHEN 'a' THEN greatest(en, len) WHEN 'b' THEN greatest(en, oen) ELSE en END,
    CASE WHEN k = 'push' THEN ospk ELSE spk END, CASE WHEN k = 'c' THEN least(lst, s) END, k = 'a' FROM (
    SELECT *, CASE WHEN skip THEN 'skip' WHEN oen - s >= 600.0 THEN 'push' WHEN near AND lspk = spk AND lst - oen <= 900.0 THEN 'a' WHEN near THEN 'b' WHEN lst - oen <= 900.0 THEN 'c' ELSE 'push' END AS k FROM (
      SELECT f.file, l.rn, f.idx, f.st, f.en, f.spk, f.skip, l.en AS oen, l.spk AS ospk, l.lst, l.len, l.lspk, coalesce(f.nst, l.st) AS s, f.idx >= 0 AND coalesce(f.nst, l.st) - f.en <= 900.0 AS near
      FROM f JOIN l ON l.file = f.file AND l.rn = f.rn + 1)))
SELECT file, idx, st, en, spk FROM f WHERE idx >= 0 QUALIFY row_number() OVER (PARTITION BY file, idx ORDER BY rn DESC) = 1""")
def smooth_turns(spark, sf):
    return sequences.smooth_turns(turns(spark, sf), 600.0, 900.0)


@query(f"""WITH RECURSIVE {TURNS}, f AS (
  SELECT file, rn, 0 AS idx, st, en, (en - st) / 1.0 >= 30000.0 AS closed FROM o WHERE rn = 1
  UNION ALL
  SELECT o.file, o.rn, CASE WHEN f.closed THEN f.idx + 1 ELSE f.idx END, CASE WHEN f.closed THEN o.st ELSE f.st END, o.en, (o.en - CASE WHEN f.closed THEN o.st ELSE f.st END) / 1.0 >= 30000.0
  FROM f JOIN o ON o.file = f.file AND o.rn = f.rn + 1)
SELECT file, idx, st, en FROM f QUALIFY row_number() OVER (PARTITION BY file, idx ORDER BY rn DESC) = 1""")
def vad_group(spark, sf):
    return sequences.group_vad(turns(spark, sf), 30000.0, 1.0)


@query(f"""WITH RECURSIVE {TURNS}, f AS (
  SELECT file, rn, 0 AS g, st, en FROM o WHERE rn = 1
  UNION ALL
  SELECT o.file, o.rn, CASE WHEN o.en - f.st <= 30000.0 THEN f.g ELSE f.g + 1 END, CASE WHEN o.en - f.st <= 30000.0 THEN f.st ELSE o.st END, CASE WHEN o.en - f.st <= 30000.0 THEN greatest(f.en, o.en) ELSE o.en END
  FROM f JOIN o ON o.file = f.file AND o.rn = f.rn + 1),
g AS (SELECT file, g, st, en FROM f QUALIFY row_number() OVER (PARTITION BY file, g ORDER BY rn DESC) = 1),
p AS (SELECT file, g, 0 AS i, st, en FROM g UNION ALL SELECT file, g, i + 1, st + 30000.0, en FROM p WHERE en - st > 30000.0)
SELECT file, (row_number() OVER (PARTITION BY file ORDER BY g, i) - 1)::INTEGER AS idx, st, CASE WHEN en - st > 30000.0 THEN st + 30000.0 ELSE en END AS en FROM p WHERE en > st""")
def vad_chunks(spark, sf):
    return sequences.vad_chunks(turns(spark, sf), 30000.0, 1.0)


@query("""WITH l AS (SELECT event_id, user_id % 7 AS c, CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN '1.00 2.00' ELSE printf('%.2f %.2f spk%d', (event_id % 50) / 4.0, (event_id % 50) / 4.0 + 3, event_id % 3) END AS line FROM events),
t AS (SELECT event_id, c, string_split(line, ' ') AS t FROM l WHERE len(string_split(line, ' ')) >= 3)
SELECT event_id AS file, c * 10 + t[1]::DOUBLE AS st, least(c * 10 + t[2]::DOUBLE, c * 10 + 10.0::DOUBLE) AS en, printf('chunk_%05d_%s', c, t[3]) AS spk, c::INTEGER AS chunk_index FROM t WHERE least(c * 10 + t[2]::DOUBLE, c * 10 + 10.0) > c * 10 + t[1]::DOUBLE""")
def diarization_lines(spark, sf):
    at, c = (F.col("event_id") % 50) / 4.0, (F.col("user_id") % 7).cast("int")
    rows = table(spark, sf, "events").select(F.col("event_id").alias("file"), c.alias("chunk_index"), (c * 10).cast("double").alias("chunk_start"), (c * 10 + 10).cast("double").alias("chunk_end"), F.when(F.col("event_id") % 11 == 0, "").when(F.col("event_id") % 11 == 1, "1.00 2.00").otherwise(F.format_string("%.2f %.2f spk%d", at, at + 3, F.col("event_id") % 3)).alias("line"))
    return sequences.parse_turns(rows)


# --- utterances


@query(f"""WITH {UTTERANCES}, u AS (SELECT *, trim(text, ' \n\t') AS t FROM utts WHERE trim(text, ' \n\t') <> ''),
j AS (SELECT *, CASE WHEN lag(spk) OVER w = spk AND NOT regexp_matches(lag(t) OVER w, '[.?!]$') THEN 0 ELSE 1 END AS b FROM u WINDOW w AS (PARTITION BY file ORDER BY idx)),
p AS (SELECT *, sum(b) OVER (PARTITION BY file ORDER BY idx) AS part FROM j)
SELECT file, (part - 1)::INTEGER AS idx, min(st) AS st, max(en) AS en, min_by(spk, idx) AS spk, string_agg(t, ' ' ORDER BY idx) AS text, count(*) AS n, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS sources FROM p GROUP BY file, part""".replace(r"' \n\t'", r"' ' || chr(10) || chr(9)"))
def merge_transcripts(spark, sf):
    return utterance_sources(sequences.merge_transcripts(utterances(spark, sf)))


def utterance_sources(df: DataFrame) -> DataFrame:
    """The joined utterances as text, without the lists that these have none for."""
    out = df.withColumn("sources", F.array_join(F.transform("source_utterance_indices", lambda x: x.cast("string")), ","))
    return out.drop("source_utterance_indices", "source_speaker_ids", "source_chunk_indices")


CAPPED = f"""{UTTERANCES}, u AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY idx) AS rn, idx AS own, st, en, spk, trim(text, ' ' || chr(10) || chr(9)) AS t FROM utts WHERE trim(text, ' ' || chr(10) || chr(9)) <> ''), f AS (
  SELECT file, rn, 0 AS idx, st, en, spk, t AS text, 1::BIGINT AS n, own::VARCHAR AS sources FROM u WHERE rn = 1
  UNION ALL
  SELECT file, rn, CASE WHEN j THEN idx ELSE idx + 1 END, CASE WHEN j THEN st ELSE ost END, CASE WHEN j THEN greatest(en, oen) ELSE oen END, ospk, CASE WHEN j THEN text || ' ' || ot ELSE ot END, CASE WHEN j THEN n + 1 ELSE 1 END, CASE WHEN j THEN sources || ',' || own ELSE own::VARCHAR END FROM (
    SELECT f.*, u.rn AS urn, u.own, u.st AS ost, u.en AS oen, u.spk AS ospk, u.t AS ot, u.spk = f.spk AND (f.en - f.st) + (u.en - u.st) <= 12.0 AND NOT regexp_matches(f.text, '[.?!]$') AS j
    FROM f JOIN u ON u.file = f.file AND u.rn = f.rn + 1)
), m AS (SELECT file, idx, st, en, spk, text, n, sources FROM f QUALIFY row_number() OVER (PARTITION BY file, idx ORDER BY rn DESC) = 1)""".replace("SELECT file, rn, CASE WHEN j", "SELECT file, urn, CASE WHEN j")


@query(f"WITH RECURSIVE {CAPPED} SELECT * FROM m")
def merge_transcripts_capped(spark, sf):
    return utterance_sources(sequences.merge_transcripts_capped(utterances(spark, sf), 12.0))


@query(r"""WITH RECURSIVE c AS (SELECT conv_id AS file, turn AS idx, 0.0::DOUBLE AS st, length(text) / 15.0::DOUBLE AS en, role AS spk, text, string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)) AS x FROM conversations),
d AS (SELECT *, list_sum(list_transform(x, lambda p: length(p))) AS total FROM c WHERE en - st > 10.0 AND len(x) > 1),
s AS (SELECT file, idx, spk, st, en, total, x, 1 AS i, 0 AS n, st AS begin, 0::BIGINT AS size, ''::VARCHAR AS held, NULL::DOUBLE AS was, NULL::VARCHAR AS said FROM d
  UNION ALL
  SELECT file, idx, spk, st, en, total, x, i + 1, CASE WHEN cut THEN n + 1 ELSE n END, CASE WHEN cut THEN begin + (size / total) * (en - st) ELSE begin END,
    CASE WHEN cut THEN length(x[i]) ELSE size + length(x[i]) END, CASE WHEN cut OR held = '' THEN x[i] ELSE held || ' ' || x[i] END, CASE WHEN cut THEN begin END, CASE WHEN cut THEN held END FROM (
    SELECT *, size > 0 AND (begin + ((size + length(x[i])) / total) * (en - st)) - begin > 10.0 AS cut FROM s WHERE i <= len(x)))
SELECT file, idx::INTEGER AS idx, (n - 1)::INTEGER AS piece, was AS st, begin AS en, spk, said AS text FROM s WHERE said IS NOT NULL
UNION ALL SELECT file, idx::INTEGER, n::INTEGER, begin, en, spk, held FROM s WHERE i = len(x) + 1
UNION ALL SELECT file, idx::INTEGER, 0, st, en, spk, text FROM c WHERE NOT (en - st > 10.0 AND len(x) > 1)""")
def split_sentences(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").cast("int").alias("idx"), F.lit(0.0).alias("st"), (F.length("text") / 15.0).alias("en"), F.col("role").alias("spk"), "text")
    return sequences.split_sentences(c, 10.0).select("file", "idx", "piece", "st", "en", "spk", "text")


@query(f"""WITH RECURSIVE {UTTERANCES}, u AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY idx) AS rn FROM utts WHERE en > st), f AS (
  SELECT file, rn, idx, 0 AS sample, st, en, spk, 0.0::DOUBLE + (en - st) AS length, [spk] AS who FROM u WHERE rn = 1
  UNION ALL
  SELECT file, rn, idx, CASE WHEN j THEN sample + 1 ELSE sample END, st, en, spk, CASE WHEN j THEN 0.0::DOUBLE + (en - st) ELSE length + (en - st) END, CASE WHEN j THEN [spk] ELSE list_distinct(list_append(who, spk)) END FROM (
    SELECT u.*, f.sample, f.length, f.who, f.length + (u.en - u.st) > 25.0 OR (NOT list_contains(f.who, u.spk) AND len(f.who) + 1 > 2) AS j FROM f JOIN u ON u.file = f.file AND u.rn = f.rn + 1))
SELECT file, idx::BIGINT AS idx, sample, st, en, spk FROM f""")
def pack_samples(spark, sf):
    return sequences.pack_samples(utterances(spark, sf), 25.0, 2)


RENDER = """first AS (SELECT file, spk, min(idx) AS f FROM utts GROUP BY file, spk), num AS (SELECT file, spk, row_number() OVER (PARTITION BY file ORDER BY f) - 1 AS k FROM first),
u AS (SELECT file, idx, k, trim(text) AS t FROM utts JOIN num USING (file, spk) WHERE trim(text) <> '')"""


@query(f"""WITH {UTTERANCES}, {RENDER}, r AS (SELECT *, CASE WHEN lag(k) OVER (PARTITION BY file ORDER BY idx) = k THEN 0 ELSE 1 END AS b FROM u),
s AS (SELECT *, sum(b) OVER (PARTITION BY file ORDER BY idx) AS run FROM r), l AS (SELECT file, run, 'Speaker ' || k || ': ' || string_agg(t, ' ' ORDER BY idx) AS line FROM s GROUP BY file, run, k)
SELECT file, string_agg(line, chr(10) ORDER BY run) AS text FROM l GROUP BY file""")
def render_transcript(spark, sf):
    return samples.render(utterances(spark, sf), ["file"], "idx")


@query(r"""WITH c AS (SELECT conv_id AS file, turn AS idx, role AS spk, regexp_replace(text, '^\s+|\s+$', '', 'g') AS s FROM conversations),
m AS (SELECT *, string_split(regexp_replace(s, '([.?!])\s+([a-zæøåäöü])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS x FROM c WHERE s <> ''), first AS (SELECT file, spk, min(idx) AS f FROM m GROUP BY file, spk),
num AS (SELECT file, spk, row_number() OVER (PARTITION BY file ORDER BY f) - 1 AS k FROM first)
SELECT file, string_agg('Speaker ' || k || ': ' || array_to_string(list_transform(x, lambda p: upper(p[1]) || p[2:]), ' '), chr(10) ORDER BY idx) AS text FROM m JOIN num USING (file, spk) GROUP BY file""")
def render_lines(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("idx"), F.col("role").alias("spk"), "text")
    return samples.render_lines(c, ["file"], "idx")


@query(f"WITH {UTTERANCES} SELECT file, spk, min(st) AS st, max(en) AS en, greatest(0.0, max(en) - min(st)) AS duration, count(*) AS n FROM utts GROUP BY file, spk")
def sample_spans(spark, sf):
    return samples.spans(utterances(spark, sf), ["file", "spk"])


# --- prompts


def clips(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("spk"), F.col("event_id").alias("seq"), F.format_string("clip_%06d.wav", "event_id").alias("path"), (F.col("value") / 4).alias("duration"), F.col("user_id").alias("file"))


CLIPS = "clips AS (SELECT event_type AS spk, event_id AS seq, printf('clip_%06d.wav', event_id) AS path, value / 4 AS duration, user_id AS file FROM events)"


@query(f"WITH {CLIPS} SELECT file, spk, string_agg(path, ',' ORDER BY seq) AS paths, count(*) AS n FROM clips WHERE duration BETWEEN 3 AND 15 GROUP BY file, spk")
def prompt_candidates(spark, sf):
    out = prompts.index(clips(spark, sf), ["file", "spk"], "seq", prompts.PIPELINE_RANGE)
    return out.select("file", "spk", F.array_join("paths", ",").alias("paths"), F.size("paths").cast("long").alias("n"))


@query(f"""WITH {CLIPS}, c AS (SELECT file || '/' || spk AS s, path FROM clips WHERE duration BETWEEN 10 AND 25),
w AS (SELECT file, seq, file || '/' || spk AS s, path FROM clips), p AS (SELECT w.file, w.seq, min(c.path) AS pick FROM w LEFT JOIN c ON c.s = w.s AND c.path <> w.path GROUP BY ALL)
SELECT file, CASE WHEN bool_and(pick IS NOT NULL) THEN string_agg(pick, ',' ORDER BY seq) END AS prompts FROM p GROUP BY file""")
def prompt_select(spark, sf):
    c = clips(spark, sf).withColumn("spk", F.concat(F.col("file").cast("string"), F.lit("/"), "spk"))
    out = prompts.select_prompts(c.select("file", "seq", "spk", F.col("path").alias("exclude")), prompts.candidates(c, prompts.CORPUS_RANGE).select("spk", "path"), ["file"], "seq")
    return out.select("file", F.array_join("prompts", ",").alias("prompts"))


@query(f"""WITH {CLIPS}, k AS (SELECT *, duration BETWEEN 10 AND 25 AS ok, sum(CASE WHEN duration BETWEEN 10 AND 25 THEN 1 ELSE 0 END) OVER (PARTITION BY spk ORDER BY seq) AS k FROM clips)
SELECT a.seq, a.spk, coalesce(string_agg(b.path, ',' ORDER BY b.seq), '') AS available FROM k a LEFT JOIN k b ON b.spk = a.spk AND b.ok AND b.seq <= a.seq AND b.k > a.k - 50 AND b.path <> a.path GROUP BY ALL""")
def rolling_prompt_cache(spark, sf):
    return prompts.rolling_cache(clips(spark, sf)).select("seq", "spk", F.array_join("available", ",").alias("available"))


@query(f"WITH {CLIPS} SELECT spk, count(*) FILTER (duration BETWEEN 10 AND 25) AS assigned, count(*) AS single FROM clips GROUP BY spk")
def assignment_count(spark, sf):
    return clips(spark, sf).groupBy("spk").agg(F.count_if(F.col("duration").between(10, 25)).alias("assigned"), F.count("*").alias("single"))


@query("SELECT event_id % 2000 AS utterance, count(DISTINCT event_type) = 1 AND count(DISTINCT nullif(event_id % 3, 0)) = 1 AS sole FROM events GROUP BY 1")
def single_source(spark, sf):
    key = (F.col("event_id") % 2000).alias("utterance")
    e = table(spark, sf, "events").groupBy(key).agg(F.collect_list("event_type").alias("s"), F.collect_list(F.nullif(F.col("event_id") % 3, F.lit(0))).alias("c"))
    return e.select("utterance", prompts.single_source(F.col("s"), F.col("c")).alias("sole"))


# --- waveforms


@query(f"""WITH f AS (SELECT vec_id, embedding AS a, list_transform(range(0, 16), lambda i: sqrt(list_reduce(list_transform(embedding[i * 4 + 1 : i * 4 + 4], lambda x: x::DOUBLE * x::DOUBLE), lambda s, x: s + x) / 4)) AS r FROM embeddings),
g AS (SELECT vec_id, len(a) AS n, list_filter(range(0, 16), lambda i: r[i + 1] >= list_max(r) * {10.0 ** (-6 / 20)!r}) AS t FROM f)
SELECT vec_id, greatest(0, t[1] * 4 - 4)::INTEGER AS head, (n - least(n, (t[-1] + 1) * 4 + 8))::INTEGER AS tail, (least(n, (t[-1] + 1) * 4 + 8) - greatest(0, t[1] * 4 - 4))::INTEGER AS n FROM g""")
def trim_silence(spark, sf):
    out = waveform.trim_silence(table(spark, sf, "embeddings"), "embedding", 4, 4, -6.0)
    return out.select("vec_id", F.col("head").cast("int").alias("head"), F.col("tail").cast("int").alias("tail"), F.size("embedding").alias("n"))


@query("""WITH m AS (SELECT vec_id, label, list_transform(range(1, 65), lambda i: (embedding[i]::DOUBLE + embedding[65 - i]::DOUBLE) / 2) AS mono FROM embeddings),
s AS (SELECT vec_id, label, mono[11:20] AS part FROM m), g AS (SELECT label, flatten(list(part ORDER BY vec_id)) AS line FROM s GROUP BY label)
SELECT label, len(line) AS n, line[1] AS first, line[-1] AS last, line[len(line) // 2] AS middle FROM g""")
def downmix_slice_concat(spark, sf):
    e = table(spark, sf, "embeddings")
    mono = waveform.downmix(F.array(F.col("embedding"), F.reverse("embedding")))
    parts = e.select("label", "vec_id", waveform.cut(mono, F.lit(10), F.lit(20)).alias("samples"))
    line = waveform.concatenate(parts, ["label"], "vec_id")
    n = F.size("samples")
    return line.select("label", n.cast("long").alias("n"), F.get("samples", F.lit(0)).alias("first"), F.get("samples", n - 1).alias("last"), F.get("samples", (n / 2).cast("int") - 1).alias("middle"))


@query("SELECT vec_id, len(embedding[1:16]) AS n, least((vec_id % 9) * 10, len(embedding))::BIGINT AS at FROM embeddings")
def clip_and_index(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.size(waveform.clip(F.col("embedding"), 0.5, 32)).cast("long").alias("n"), waveform.sample_index((F.col("vec_id") % 9).cast("double"), F.lit(10), F.size("embedding")).alias("at"))


@query(f"""WITH {TURNS} SELECT file, seq, st + (seq % 40) / 8.0::DOUBLE AS st, en - (seq % 24) / 8.0::DOUBLE AS en FROM o WHERE en - (seq % 24) / 8.0::DOUBLE > st + (seq % 40) / 8.0::DOUBLE""")
def shift_after_trim(spark, sf):
    t = turns(spark, sf).withColumns({"head": F.col("seq") % 40, "tail": F.col("seq") % 24, "rate": F.lit(8.0)})
    return waveform.shift_after_trim(t).select("file", "seq", "st", "en")


# --- whole graphs


@query(f"""WITH {UTTERANCES} SELECT file, count(*) AS utterances, max(en) AS duration FROM utts GROUP BY file""")
def transcript_overview(spark, sf):
    return utterances(spark, sf).groupBy("file").agg(F.count("*").alias("utterances"), F.max("en").alias("duration"))


@query()
def pipeline_e2e(spark, sf):
    """Conversations through merging by text, splitting, packing and rendering."""
    joined = sequences.merge_transcripts_capped(utterances(spark, sf))
    split = sequences.split_sentences(joined)
    order = split.withColumn("idx", F.row_number().over(Window.partitionBy("file").orderBy("idx", "piece")).cast("long"))
    packed = sequences.pack_samples(order)
    rows = packed.join(order.select("file", "idx", "text"), ["file", "idx"])
    span = samples.spans(rows, ["file", "sample"]).select("file", "sample", "duration", "n")
    return samples.render(rows, ["file", "sample"], "idx").join(span, ["file", "sample"])
