"""Texts cut off by field limits, in SQL over word trigrams.

A text that was cut ends with a trigram that is frequent inside texts and
almost never ends one, or inside a word: its last token is a proper beginning
of words that follow the two before it. Signatures, lists, tables, dates and
remarks end texts often, each in their own words, so they stay.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cernido.tables import bounded_broadcast, spread, written

#: below this share of its inner occurrences a trigram is "almost never terminal"
RARE_END = 0.02
#: so many other texts at least must end alike for an ending to count as usual
USUAL_END = 2
#: what a source may put after the cut, at most eight characters; and broken characters, however many
MARK, BROKEN = r"\[?\(?(…|\.\.\.)\)?\]?$", "�"
#: white space as the character sets of both SQL and Unicode have it
BLANKS = "\t\n\x0b\x0c\r " + "".join(c for c in map(chr, range(0xA0, 0x3001)) if unicodedata.category(c) in ("Zs", "Zl", "Zp"))


@lru_cache(maxsize=1)
def _fold() -> tuple[str, str]:
    """One character for one: lower case, Latin letters without accents, each
    digit as 9, every blank as a space and every line end as a line feed."""
    plain = {c: " " for c in BLANKS} | {"\n": "\n", "\r": "\n"}
    for c in map(chr, range(0x21, 0x10000)):
        if c.isdigit() and c.isascii():
            plain[c] = "9"
        elif c not in plain and c.isalpha():
            low = c.lower()
            base = unicodedata.normalize("NFD", low)[0]
            low = base if base.isascii() else low
            if len(low) == 1 and low != c:
                plain[c] = low
    return "".join(plain), "".join(plain.values())


# ``body``: words in lower case without accents, each digit as 9, each Han
# character a word; one blank between words, one line feed between lines. The
# whole text is folded in one pass and only touched again where it must be.
_FOLDED = r"""
SELECT doc_id, source, h, mark, closed,
       CASE WHEN octet_length(body) > length(body) + 1 AND body RLIKE '\\p{{IsHan}}'
            THEN trim(regexp_replace(regexp_replace(body, '\\p{{IsHan}}', ' $0 '), ' *(\\n| ) *', '$1')) ELSE body END AS body
FROM (
  SELECT doc_id, source, h, mark, closed,
         trim(' \n' FROM CASE WHEN contains(body, '\n\n') OR contains(body, '\n ') THEN regexp_replace(body, '\\n[\\n ]+', '\n') ELSE body END) AS body
  FROM (
    SELECT doc_id, source, h, mark, closed,
           replace(CASE WHEN contains(body, '  ') THEN regexp_replace(body, ' {{2,}}', ' ') ELSE body END, ' \n', '\n') AS body
    FROM (
      SELECT doc_id, source, xxhash64(t) AS h, mark,
             mark = '' AND right(trim(TRAILING '"”»)' FROM t), 1) IN ('.', '?', '!', '。', '؟', '！', '？') AS closed,
             translate(CASE WHEN mark = '' THEN t WHEN mark = :broken THEN trim(TRAILING :broken FROM t)
                            ELSE left(t, length(t) - length(mark)) END, :from, :to) AS body
      FROM (SELECT *, CASE WHEN endswith(t, :broken) THEN :broken ELSE regexp_extract(right(t, 8), :mark, 0) END AS mark
            FROM (SELECT doc_id, source, trim(TRAILING :blanks FROM text) AS t FROM {docs} WHERE text IS NOT NULL)
            WHERE t <> ''))))
"""

# The first word of a line starts with the sign for the line end.
_INNER = """
SELECT a, b, x, count(*) AS n
FROM (SELECT inline(arrays_zip(concat(array('', ''), w), concat(array(''), w), w)) AS (a, b, x)
      FROM (SELECT split(replace(body, '\n', ' ⏎'), ' ') AS w FROM {folded} WHERE body <> ''))
WHERE x IS NOT NULL
GROUP BY ALL
"""

# ``line``: the last line of a text of several, a number being one 9; else the
# line feed that no line holds.
_ENDS = r"""
SELECT doc_id, source, h, mark, closed, line,
       CASE WHEN size(w) > 2 THEN w[size(w) - 3] ELSE '' END AS a,
       CASE WHEN size(w) > 1 THEN w[size(w) - 2] ELSE '' END AS b,
       w[size(w) - 1] AS x
FROM (SELECT doc_id, lower(source) AS source, h, mark, closed, split(substring_index(replace(body, '\n', ' ⏎'), ' ', -3), ' ') AS w,
             CASE WHEN contains(body, '\n') THEN regexp_replace(substring_index(body, '\n', -1), '9+', '9') ELSE '\n' END AS line
      FROM {folded})
"""

# The lines of all texts after the first.
_EACH_LINE = r"""
SELECT h, line_no, CASE WHEN contains(l, '99') THEN regexp_replace(l, '9+', '9') ELSE l END AS l
FROM (SELECT h, posexplode(split(body, '\n')) AS (line_no, l) FROM {folded} WHERE contains(body, '\n'))
WHERE line_no > 0
"""

# How often lines end after the words of a last line, and how often they go on.
# Last lines of up to eight words are found among the beginnings of all lines,
# longer ones among the whole lines. Lines are shuffled as two 64-bit hashes.
_BEGUN = r"""
WITH wanted AS (
  SELECT DISTINCT line, xxhash64(line) AS k1, xxhash64(line, 1) AS k2 FROM {ends} WHERE NOT closed AND line <> '\n'),
begun AS (
  SELECT k1, k2, count(DISTINCT CASE WHEN whole THEN h END) AS whole, count_if(NOT whole) AS longer
  FROM (SELECT h, xxhash64(p) AS k1, xxhash64(p, 1) AS k2, p = l AS whole
        FROM (SELECT h, l, explode(array_distinct(array(substring_index(l, ' ', 1), substring_index(l, ' ', 2), substring_index(l, ' ', 3), substring_index(l, ' ', 4),
                substring_index(l, ' ', 5), substring_index(l, ' ', 6), substring_index(l, ' ', 7), substring_index(l, ' ', 8), l))) AS p FROM {each}))
  GROUP BY k1, k2)
SELECT line, whole, longer FROM begun JOIN wanted USING (k1, k2)
"""

# Lines of over eight words that end texts or lines as often as a usual ending must.
_LONG = r"""
SELECT line, substring_index(line, ' ', 8) AS head FROM {begun} WHERE whole > :usual AND substring_index(line, ' ', 8) <> line
"""

# How often lines go on after those: by running hashes of the words of the
# lines that share their first eight.
_LINES = r"""
WITH marks AS (
  SELECT line, max(k) AS k, sum(shiftright(xxhash64(k, x), 20)) AS s1, sum(shiftright(xxhash64(x, k), 20)) AS s2
  FROM (SELECT line, posexplode(split(line, ' ')) AS (k, x) FROM {long}) GROUP BY line),
words AS (
  SELECT h, line_no, size(w) AS n, posexplode(w) AS (k, x)
  FROM (SELECT h, line_no, split(l, ' ') AS w
        FROM (SELECT *, substring_index(l, ' ', 8) AS head FROM {each}) JOIN {heads} USING (head) WHERE head <> l)),
sums AS (
  SELECT k, n, sum(shiftright(xxhash64(k, x), 20)) OVER w AS s1, sum(shiftright(xxhash64(x, k), 20)) OVER w AS s2
  FROM words WINDOW w AS (PARTITION BY h, line_no ORDER BY k ROWS UNBOUNDED PRECEDING)),
found AS (
  SELECT * FROM {begun}
  UNION ALL
  SELECT line, 0, count(*) FROM sums JOIN marks USING (k, s1, s2) WHERE k < n - 1 GROUP BY line)
SELECT line, sum(whole) AS whole, sum(longer) AS longer FROM found GROUP BY line
"""

# The inner count of an ending is that of its words less the texts that end in
# them. Each distinct text counts once as an end. Beginnings of words are made
# of the distinct word sequences that share their first words with an end. All
# is judged by distinct ending, so a frequent one is a single row.
_JUDGED = """
WITH open AS (SELECT a, b, x, mark, line, h, count(*) AS n FROM {ends} WHERE NOT closed GROUP BY ALL),
t4 AS (SELECT a, b, x, mark, line FROM open GROUP BY ALL),
t3 AS (SELECT a, b, x, mark, count(DISTINCT h) - 1 AS others FROM open GROUP BY ALL),
t2 AS (SELECT b, x, mark, count(DISTINCT h) - 1 AS others FROM open GROUP BY ALL),
t1 AS (SELECT x, mark, count(DISTINCT h) - 1 AS others FROM open GROUP BY ALL),
a3 AS (SELECT a, b, x, count(*) AS ending FROM {ends} GROUP BY ALL),
a2 AS (SELECT b, x, sum(ending) AS ending FROM a3 GROUP BY ALL),
a1 AS (SELECT x, sum(ending) AS ending FROM a2 GROUP BY ALL),
p2 AS (SELECT b, x, sum(n) AS n FROM {inner} GROUP BY b, x),
p1 AS (SELECT x, sum(n) AS n FROM p2 GROUP BY x),
g3 AS (
  SELECT a, b, left(x, k) AS x, sum(CASE WHEN k = length(x) THEN n ELSE 0 END) AS whole,
         sum(CASE WHEN k < length(x) THEN n ELSE 0 END) AS longer
  FROM (SELECT i.*, explode(sequence(1, length(x))) AS k FROM {inner} i LEFT SEMI JOIN t3 USING (a, b)) GROUP BY ALL),
g2 AS (
  SELECT b, left(x, k) AS x, sum(CASE WHEN k = length(x) THEN n ELSE 0 END) AS whole,
         sum(CASE WHEN k < length(x) THEN n ELSE 0 END) AS longer
  FROM (SELECT p.*, explode(sequence(1, length(x))) AS k FROM p2 p LEFT SEMI JOIN t2 USING (b)) GROUP BY ALL),
g1 AS (
  SELECT left(x, k) AS x, sum(CASE WHEN k = length(x) THEN n ELSE 0 END) AS whole,
         sum(CASE WHEN k < length(x) THEN n ELSE 0 END) AS longer
  FROM (SELECT p.*, explode(sequence(1, length(x))) AS k FROM p1 p) GROUP BY ALL)
SELECT o.a, o.b, o.x, o.mark, o.line,
       t3.others AS ends3, coalesce(g3.whole, 0) - a3.ending AS inner3, coalesce(g3.longer, 0) AS longer3,
       t2.others AS ends2, coalesce(g2.whole, 0) - a2.ending AS inner2, coalesce(g2.longer, 0) AS longer2,
       t1.others AS ends1, coalesce(g1.whole, 0) - a1.ending AS inner1, coalesce(g1.longer, 0) AS longer1,
       coalesce(l.whole, 0) AS line_whole, coalesce(l.longer, 0) AS line_longer
FROM t4 o
JOIN t3 USING (a, b, x, mark) JOIN t2 USING (b, x, mark) JOIN t1 USING (x, mark)
JOIN a3 USING (a, b, x) JOIN a2 USING (b, x) JOIN a1 USING (x)
LEFT JOIN g3 USING (a, b, x) LEFT JOIN g2 USING (b, x) LEFT JOIN g1 USING (x)
LEFT JOIN {lines} l USING (line)
"""

# The longest word sequence that is known inside texts decides.
_CUT = r"""
SELECT DISTINCT doc_id, source FROM {ends} JOIN (
  SELECT a, b, x, mark, line FROM {judged}
  WHERE NOT (line <> '\n' AND mark = '' AND line_whole > :usual AND line_whole >= :rare * line_longer)
    AND CASE WHEN ends3 >= :usual AND ends3 >= :rare * (inner3 + longer3) THEN false
             WHEN inner3 + longer3 > 1 THEN true
             WHEN ends2 >= :usual AND ends2 >= :rare * (inner2 + longer2) THEN false
             WHEN inner2 + longer2 > 1 THEN true
             WHEN ends1 >= :usual AND ends1 >= :rare * (inner1 + longer1) THEN false
             ELSE inner1 + longer1 > 1 END) USING (a, b, x, mark, line)
WHERE NOT closed
"""


def ends_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ending of every text, and each distinct ending that ends no sentence
    with the counts that decide. The corpus is folded once."""
    spark = docs.sparkSession
    chars = dict(zip(("from", "to"), _fold(), strict=True)) | {"blanks": BLANKS, "mark": MARK, "broken": BROKEN}
    folded = written(spark.sql(_FOLDED, args=chars, docs=spread(docs.select("doc_id", "source", "text"))), "folded")
    ends = written(spark.sql(_ENDS, folded=folded), "ends")
    inner = written(spark.sql(_INNER, folded=folded), "trigrams")
    each = spark.sql(_EACH_LINE, folded=folded)
    begun = written(spark.sql(_BEGUN, ends=ends, each=each), "lines")
    long = written(spark.sql(_LONG, args={"usual": USUAL_END}, begun=begun), "long")
    lines = spark.sql(_LINES, begun=begun, each=each, long=long, heads=bounded_broadcast(long.select("head").distinct()))
    return ends, spark.sql(_JUDGED, ends=ends, inner=inner, lines=lines)


def cut_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, source) of the documents whose text was cut.

    Null, empty and blank texts are never cut. A text of one or two words is
    judged by the words there are. Repeated texts count once as evidence and
    are all reported. A null source stays null; other columns are not read.
    """
    ends, judged = ends_of(docs)
    return docs.sparkSession.sql(_CUT, args={"usual": USUAL_END, "rare": RARE_END}, ends=ends, judged=judged)


def truncation_rates(docs: DataFrame) -> DataFrame:
    """(source, documents, cut, share): how often each source truncates, over
    its documents with text. Letter case of the source is no difference."""
    cut = cut_texts(docs).select("doc_id", F.lit(1).alias("is_cut"))
    rows = docs.filter(F.regexp_replace("text", r"[\s\p{Z}]+", "") != "").select("doc_id", F.lower("source").alias("source"))
    return (
        rows.join(cut, "doc_id", "left")
        .groupBy("source")
        .agg(F.count("*").alias("documents"), F.count("is_cut").alias("cut"))
        .withColumn("share", F.round(F.col("cut") / F.col("documents"), 6))
    )
