"""Text functions, sentences, segmentation and phrase mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sentences, speech, text
from ..operators import boilerplate, segment
from ..session import spread
from .base import ONCE, key, low, query, table
from .core import SPLIT_CLIPS, split_clips

SP = r"[\s\x{00a0}\x{2000}-\x{200a}\x{202f}\x{3000}]"
CL = r"""["''»”’)\]}\s\x{00a0}]"""


def once(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "clips").filter("id is not null").dropDuplicates(["id"])


@query(rf"SELECT id, trim(regexp_replace(regexp_replace(text, '{SP}+', ' ', 'g'), '(\.)\.+|(,),+|(!)!+|(\?)\?+|(;);+|(:):+', '\1\2\3\4\5\6', 'g')) AS clean FROM {ONCE}")
def light_clean(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf).select("id", text.light_clean(F.col("text")).alias("clean"))


@query(rf"""SELECT id, coalesce(regexp_matches(f, '\p{{L}}') AND f = {low("f")} AND f <> upper(translate(f, 'ıiçğöşü', 'IİÇĞÖŞÜ')), false) AS lower_start, coalesce(regexp_matches(regexp_replace(text, '{CL}+$', ''), '[.!?…]$'), false) AS sentence_end FROM (SELECT id, text, regexp_extract(text, '([\p{{L}}\p{{Nd}}])', 1) AS f FROM {ONCE})""")
def broken_ends(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf).select("id", text.is_lower_start(F.col("text")).alias("lower_start"), text.has_sentence_end(F.col("text")).alias("sentence_end"))


@query(f"SELECT id, {low('text')} AS lower_text, upper(translate(text, 'ıiçğöşü', 'IİÇĞÖŞÜ')) AS upper_text FROM {ONCE}")
def turkish_case(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf).select("id", text.lower_tr(F.col("text")).alias("lower_text"), text.upper_tr(F.col("text")).alias("upper_text"))


CORE = lambda c: rf"regexp_replace({low(rf'''regexp_replace(regexp_replace({c}, '{CL}+$', ''), '[.!?…]+$', '')''')}, '^[,;:—\-–]+|[,;:—\-–]+$', '', 'g')"
LISTED = lambda ws: ", ".join(f"'{w}'" for w in ws)
STARTS = lambda c: rf"coalesce(regexp_matches({c}, '^[\"''»”’)\]}}«(\-—]*[\p{{Lu}}\p{{Lt}}\p{{Nd}}]'), false)"
TOKENS = rf"(SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS t FROM (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\x0b\f\r]+') AS w FROM documents WHERE text IS NOT NULL))"
BOUNDARY = rf"""(SELECT doc_id, pos, t, coalesce(regexp_matches(bare, '[.!?…]$') AND NOT (regexp_matches(bare, '\.$') AND (core IN ({LISTED(sentences.ABBREVIATIONS)}) OR regexp_full_match(core, '\p{{L}}') OR (contains(core, '.') AND replace(core, '.', '') IN ({LISTED(sentences.ABBREVIATIONS)}))
      OR (regexp_full_match(core, '\p{{Nd}}+') AND ((length(core) <= 3 AND NOT coalesce(pcore IN ({LISTED(sentences.NUMBER_LABELS)}), false)) OR n IS NULL OR NOT {STARTS("n")} OR coalesce(ncore IN ({LISTED(sentences.ORDINAL_FOLLOWERS)}), false))))) AND (n IS NULL OR {STARTS("n")}), false) AS b
    FROM (SELECT doc_id, pos, t, n, regexp_replace(t, '{CL}+$', '') AS bare, {CORE("t")} AS core, {CORE("p")} AS pcore, {CORE("n")} AS ncore FROM (SELECT *, lag(t) OVER w AS p, lead(t) OVER w AS n FROM {TOKENS} WINDOW w AS (PARTITION BY doc_id ORDER BY pos))))"""


def doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(table(spark, sf, "documents").select("doc_id", "source", "text").filter("text is not null"))
    return d.select("doc_id", "source", F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda x: x != "").alias("tokens"))


@query(f"SELECT doc_id, count(*) FILTER (b) AS n_boundaries, coalesce(CAST(sum(pos) FILTER (b) AS BIGINT), 0) AS sum_pos FROM {BOUNDARY} GROUP BY doc_id")
def sentence_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: sentence ends and the sum of their positions."""
    d = doc_tokens(spark, sf).filter(F.size("tokens") > 0).withColumn("b", sentences.boundaries(F.col("tokens")))
    at = F.filter(F.transform("b", lambda x, i: F.when(x, i + 1).otherwise(0)), lambda x: x > 0)
    return d.select("doc_id", F.size(at).cast("long").alias("n_boundaries"), F.aggregate(at, F.lit(0).cast("long"), lambda s, x: s + x).alias("sum_pos"))


@query(f"SELECT doc_id, CAST(k AS INTEGER) AS sentence, CAST(min(pos) - 1 AS INTEGER) AS a, CAST(max(pos) AS INTEGER) AS b FROM (SELECT *, coalesce(sum(b::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM {BOUNDARY}) GROUP BY doc_id, k")
def sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    d = doc_tokens(spark, sf).select("doc_id", F.posexplode(sentences.sentence_spans(F.col("tokens"))).alias("sentence", "s"))
    return d.select("doc_id", "sentence", "s.a", "s.b")


@query()
def to_spoken(spark: SparkSession, sf: str) -> DataFrame:
    """Needs callbacks and look-around: no SQL twin, tested against known readings."""
    return once(spark, sf).select("id", speech.to_spoken("text").alias("spoken"))


ONE_BYTE = lambda c: f"translate({key(c)}, 'ıçğöşüâîû', 'ABCDEFGHI')"  # noqa: E731 - the SQL engine counts bytes


@query(rf"SELECT id, round(levenshtein({ONE_BYTE('text')}, {ONE_BYTE('text_spoken')}) / length({key('text')}), 6) AS cer FROM {ONCE} WHERE length({key('text')}) > 0")
def cer_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf).select("id", F.round(text.cer(F.col("text"), F.col("text_spoken")), 6).alias("cer")).join(once(spark, sf).select("id", text.dedupe_key(F.col("text")).alias("k")).filter("k <> ''"), "id", "left_semi")


WORDS = rf"""(SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY idx, id, i) AS pos, t AS text, start_sec + (i - 1) * ((end_sec - start_sec) / n) AS start, start_sec + i * ((end_sec - start_sec) / n) AS "end", i AS i, n, idx, id FROM (SELECT source_id, id, idx, start_sec, end_sec, len(w) AS n, generate_subscripts(w, 1) AS i, unnest(w) AS t
    FROM (SELECT *, regexp_extract_all(text, '[^ \t\n\x0b\f\r]+') AS w FROM {ONCE} WHERE source_id IS NOT NULL AND text IS NOT NULL AND end_sec > start_sec)))"""


def timed_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all recordings: those of each clip spread evenly over its time."""
    c = once(spark, sf).filter("source_id is not null AND text is not null AND end_sec > start_sec")
    w = F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda x: x != "")
    c = c.select("source_id", "id", "idx", "start_sec", "end_sec", w.alias("w")).withColumn("step", (F.col("end_sec") - F.col("start_sec")) / F.size("w"))
    x = c.select("source_id", "id", "idx", "start_sec", "step", F.posexplode("w").alias("i", "text"))
    pos = F.row_number().over(Window.partitionBy("source_id").orderBy("idx", "id", "i"))
    return x.select("source_id", pos.alias("pos"), "text", (F.col("start_sec") + F.col("i") * F.col("step")).alias("start"), (F.col("start_sec") + (F.col("i") + 1) * F.col("step")).alias("end"), F.lit(None).cast("double").alias("prob"))


@query(rf"""WITH w AS (SELECT *, NOT regexp_matches(text, '[\p{{L}}\p{{N}}]') OR regexp_matches(text, '^\s*\.\p{{Lu}}\.?\s*$') OR regexp_matches(text, '^\s*[''’\-–]\p{{Ll}}') AS c FROM {WORDS}), g AS (SELECT *, sum(CASE WHEN c AND pos > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY source_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS k FROM w)
    SELECT source_id, count(*) AS n_words, CAST(sum(length(t)) AS BIGINT) AS n_chars FROM (SELECT source_id, k, string_agg(text, '' ORDER BY pos) AS t FROM g GROUP BY source_id, k) GROUP BY source_id""")
def attach_clitics(spark: SparkSession, sf: str) -> DataFrame:
    """Per recording: words after clitics are attached, and their characters."""
    r = segment.gather_words(timed_words(spark, sf)).withColumn("words", segment.attach_clitics(F.col("words")))
    return r.select("source_id", F.size("words").cast("long").alias("n_words"), F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.length(w["text"])).alias("n_chars"))


def segmented(spark: SparkSession, sf: str) -> DataFrame:
    r = segment.gather_words(timed_words(spark, sf)).withColumn("words", segment.attach_clitics(F.col("words")))
    return segment.segment(r).withColumn("duration", F.col("end") - F.col("start"))


@query()
def segment_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy joining is sequential: no SQL twin, tested by invariants and against a plain loop."""
    return segmented(spark, sf).select("source_id", "idx", "start", "end", "text", "a", "b", F.array_join("flags", ",").alias("flags"))


@query()
def ablation_stats(spark: SparkSession, sf: str) -> DataFrame:
    return segment.arm_stats(segmented(spark, sf))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    c = once(spark, sf).filter("source_id is not null AND end_sec > start_sec")
    item = F.struct(F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), F.col("id"))
    return c.groupBy("source_id").agg(F.array_sort(F.collect_list(item)).alias("r")).select("source_id", F.transform("r", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("regions"))


@query()
def segment_silence(spark: SparkSession, sf: str) -> DataFrame:
    """The length cap makes it sequential: no SQL twin, tested against a plain loop."""
    return segment.silence_clips(regions(spark, sf)).select("source_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.array_join("flags", ",").alias("flags"))


@query(f"SELECT source_id, id, round(start_sec - lag(end_sec) OVER w, 3) AS lead_gap_sec, round(lead(start_sec) OVER w - end_sec, 3) AS trail_gap_sec FROM {ONCE} WHERE source_id IS NOT NULL WINDOW w AS (PARTITION BY source_id ORDER BY start_sec, idx)")
def neighbour_gaps(spark: SparkSession, sf: str) -> DataFrame:
    c = once(spark, sf).filter("source_id is not null").withColumnsRenamed({"start_sec": "start", "end_sec": "end"})
    return segment.neighbour_gaps(c).select("source_id", "id", "lead_gap_sec", "trail_gap_sec")


@query(f"""SELECT id, round(greatest(start_sec - 0.15, (start_sec + coalesce(lag(end_sec) OVER w, 0)) / 2, 0), 6) AS pad_start, round(least(end_sec + 0.25, coalesce((end_sec + lead(start_sec) OVER w) / 2, end_sec + 0.25)), 6) AS pad_end FROM {ONCE} WHERE source_id IS NOT NULL WINDOW w AS (PARTITION BY source_id ORDER BY start_sec, idx)""")
def padding(spark: SparkSession, sf: str) -> DataFrame:
    c = once(spark, sf).filter("source_id is not null").withColumnsRenamed({"start_sec": "start", "end_sec": "end"})
    return segment.padded(c, digits=6).select("id", "pad_start", "pad_end")


@query(f"""SELECT w.source_id, CAST(w.pos AS INTEGER) AS pos, min(c.start_sec) AS clip_start FROM {WORDS} w JOIN {ONCE} c ON c.source_id = w.source_id AND (w.start + w."end") / 2 BETWEEN c.start_sec AND c.end_sec GROUP BY 1, 2""")
def word_midpoint_join(spark: SparkSession, sf: str) -> DataFrame:
    c = once(spark, sf).filter("source_id is not null").withColumnsRenamed({"start_sec": "start", "end_sec": "end"})
    return segment.words_in_clips(timed_words(spark, sf), c.filter("end >= start")).select("source_id", "pos", "clip_start")


def channel_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return doc_tokens(spark, sf).filter("source is not null").withColumnRenamed("source", "channel")


NORM = rf"""(SELECT doc_id, source, list_filter(list_transform(w[1:80] || CASE WHEN len(w) > 80 THEN w[greatest(len(w) - 79, 1):] ELSE [] END, lambda x: trim(regexp_replace(regexp_replace({low("x")}, '[^\p{{L}}\p{{N}}_\s\x{{00a0}}]', ' ', 'g'), '[\s\x{{00a0}}]+', ' ', 'g'))), lambda x: x <> '') AS w
    FROM (SELECT doc_id, source, regexp_extract_all(text, '[^ \t\n\x0b\f\r]+') AS w FROM documents WHERE text IS NOT NULL AND source IS NOT NULL))"""


@query(f"SELECT source AS channel, phrase, count(*) AS n FROM (SELECT DISTINCT doc_id, source, unnest([array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)]) AS phrase FROM {NORM}) GROUP BY 1, 2 HAVING count(*) >= 2")
def ngram_docfreq(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.document_frequency(channel_tokens(spark, sf), words=4).filter("n >= 2")


@query()
def boilerplate_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Fix-point pruning and merging: no SQL twin, tested against a plain loop."""
    return boilerplate.mine(channel_tokens(spark, sf), "doc_id").select("channel", "phrase", "n")


@query()
def phrase_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy longest-first places: no SQL twin, tested on cases."""
    t = channel_tokens(spark, sf)
    return boilerplate.find_places(t, boilerplate.mine(t, "doc_id"), "doc_id").select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.a", "s.b")


@query(f"SELECT split, k AS text_key, count(*) AS n FROM (SELECT split, {key('text')} AS k FROM {SPLIT_CLIPS}) WHERE k <> '' GROUP BY ALL HAVING count(*) > 1")
def repeated_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Text keys that several clips of a split share."""
    c = split_clips(spark, sf).select("split", text.dedupe_key(F.col("text")).alias("text_key")).filter("text_key <> ''")
    return c.groupBy("split", "text_key").agg(F.count("*").alias("n")).filter("n > 1")


@query()
def ablation_two_arms(spark: SparkSession, sf: str) -> DataFrame:
    """Both segmentations of all recordings, figures per recording and in total (null): one rollup. No SQL twin, since both arms are sequential."""
    words = timed_words(spark, sf)
    sentence = segmented(spark, sf).select(F.lit("sentence").alias("arm"), "source_id", "text", "duration", "flags")
    spans = segment.silence_clips(regions(spark, sf)).withColumnsRenamed({"start": "s", "end": "e"})
    placed = segment.words_in_clips(words, spans.select("source_id", F.col("s").alias("start"), F.col("e").alias("end")))
    texts = words.join(placed, ["source_id", "pos"]).groupBy("source_id", F.col("clip_start").alias("s"), F.col("clip_end").alias("e")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("text"))
    silence = spans.join(texts, ["source_id", "s", "e"]).select(F.lit("silence").alias("arm"), "source_id", "text", (F.col("e") - F.col("s")).alias("duration"), "flags")
    both = sentence.unionByName(silence)
    low, end = text.is_lower_start(F.col("text")), text.has_sentence_end(F.col("text"))
    r = both.rollup("arm", "source_id").agg(F.count("*").alias("n"), F.round(F.sum("duration"), 3).alias("seconds"), F.count_if(low).alias("lower_start"), F.count_if(~end).alias("no_end"), F.count_if(low & (F.size("flags") == 0)).alias("lower_start_unflagged"))
    return r.filter("arm is not null")


# Texts and how they are read.
READINGS = [
    ("%50 arttı", "yüzde elli arttı"), ("%1,5 oldu", "yüzde bir,beş oldu"), ("1,5 litre su", "bir virgül beş litre su"), ("saat 09:00 oldu", "saat dokuz oldu"), ("14:30 treni", "on dört otuz treni"), ("50₺ verdi", "elli lira verdi"), ("$20 ve 30 €", "yirmi dolar ve otuz avro"), ("50 TL", "elli lira"),
    ("1.234 kişi", "bin iki yüz otuz dört kişi"), ("1923'te doğdu", "bin dokuz yüz yirmi üç'te doğdu"), ("1001 gece", "bin bir gece"), ("101 dalmaçyalı", "yüz bir dalmaçyalı"), ("3G çekmiyor", "üç ge çekmiyor"), ("F-16 havalandı", "fe on altı havalandı"), ("MI6 ajanı", "me ı altı ajanı"), ("ABCDE-12 kodu", "ABCDE-on iki kodu"), ("mp3 ve TBMM", "mp3 ve TBMM"),
    ("3. kat", "üçüncü kat"), ("Sonra 1. Naip geldi", "Sonra birinci Naip geldi"), ("Bölüm 5. Ali eve gitti.", "Bölüm beş. Ali eve gitti."), ("bitti 1918. Yeni yıl", "bitti bin dokuz yüz on sekiz. Yeni yıl"), ("Dr. Ali vb. kişiler", "doktor Ali ve benzeri kişiler"), ("M.Ö. 3. yy. başı", "milattan önce üçüncü yüzyıl başı"), ("10-15 kişi", "on-on beş kişi"), ("Ne  güzel!!  Bitti..", "Ne güzel! Bitti."), ("", ""),
]


@query("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in READINGS) + ") t(text, spoken)")
def spoken_cases(spark: SparkSession, sf: str) -> DataFrame:
    """A table of known readings."""
    return spark.createDataFrame([(a,) for a, _ in READINGS], "text string").select("text", speech.to_spoken("text").alias("spoken"))


# Recordings of words of 0.5 s, 0.1 s apart, and the clips that come of them: (start, end, words, flags). "|" is a further pause of 2 s.
RECORDINGS = [
    ("Ali bu gün geldi. Can da evden gitti. Sonra ev boş kaldı.", [(0.0, 4.75, 8, ""), (4.75, 7.35, 4, "")]),  # the third sentence would pass the target
    ("Ali bu gün geldi. | Can da evden gitti.", [(0.0, 2.55, 4, ""), (4.25, 6.95, 4, "")]),  # a pause parts what would fit
    ("Ali " + "ve " * 10 + "bu, " + "da " * 17 + "var.", [(0.0, 7.15, 12, "forced_split"), (7.15, 18.15, 18, "forced_split")]),  # the comma nearest to the target
    ("Ali " + "ve " * 11 + "| Can " + "da " * 17 + "var.", [(0.0, 7.35, 12, "gap_split"), (9.05, 20.75, 19, "")]),  # a pause within a sentence; its second part reads like a whole one
    ("Ali " + "ve " * 28 + "var.", [(0.0, 18.15, 30, "oversize")]),  # nowhere to cut
    ("Evet.", [(0.0, 0.75, 1, "short")]),
    ("Evet. Ali " + "ve " * 12 + "geldi.", [(0.0, 9.15, 15, "")]),  # too short alone: the next one is taken in
]


def planted_words(recordings: list[str]) -> list[tuple]:
    out = []
    for r, said in enumerate(recordings):
        at, pos = 0.0, 0
        for w in said.split():
            if w == "|":
                at += 2.0
                continue
            out.append((r, pos, w, round(at, 3), round(at + 0.5, 3), None))
            at, pos = at + 0.6, pos + 1
    return out


@query("SELECT * FROM (VALUES " + ", ".join(f"({r}, {i}, {s}::DOUBLE, {e}::DOUBLE, {n}, '{f}')" for r, (_, cs) in enumerate(RECORDINGS) for i, (s, e, n, f) in enumerate(cs)) + ') t(source_id, idx, start, "end", n_words, flags)')
def segment_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Known clips of planted recordings."""
    from ..schema import WORD

    words = spark.createDataFrame(planted_words([x for x, _ in RECORDINGS]), WORD)
    return segment.segment(segment.gather_words(words)).select("source_id", "idx", "start", "end", (F.col("b") - F.col("a")).alias("n_words"), F.array_join("flags", ",").alias("flags"))
