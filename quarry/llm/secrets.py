"""Secret scan: three base patterns and a pair of character Markov models.

Base spans, leftmost and non-overlapping per kind: ``assign`` (a keyword, an
assignment and a value of 8 or more characters), ``access`` (access-key ids),
``hex`` (32 or more hexadecimal digits).

``markov`` spans are tokens that look random.  A token is a whole run of 8 or
more letters, digits and ``+ / _ . = -``.  Two first-order Markov models over
characters, one trained on labelled random strings and one on labelled
ordinary identifiers, words, paths and numbers, score every token; the
log-likelihood ratio summed over its transitions must exceed a threshold that
grows with its length.  Nothing else decides, except that tokens that overlap
a base span are left out.

Spans are (kind, start, end) in code points, the end exclusive.  Only
DataFrame functions are used: an offset is the running sum of the lengths of
the stretches between the matches and of the matches.  Null text counts as
empty and has no span.  Texts are scanned whole; repeated rows give repeated
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bound, constant_array, prefix_sums, table

# fixed values: the base patterns, the group whose length counts, and its least length
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # the maximal runs of 32 or more
}
#: Candidates of the models: whole runs of token characters.
TOKEN = r"[A-Za-z0-9+/_.=-]{8,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
SAMPLES = 400            # random strings of each form that the random model is trained on
BACKOFF = 12.0           # weight of the transitions between character classes against counted ones
THRESHOLD = (8.0, 0.12)  # least summed log-likelihood ratio in nats: constant, and for each character

# fixed values: labelled ordinary identifiers, words, names, paths and numbers
ORDINARY = """
get_user_by_id update_account_balance connection_pool_size max_retry_count default_timeout_seconds is_authenticated
customer_order_history_table product_category_name shipping_address_line_1 created_at_timestamp last_modified_by
calculateTotalPrice getElementById addEventListener removeAllChildren parseJsonResponse handleButtonClick onMouseOver
setVisible hasChildNodes toStringList fromOptions valueOfKey isNotBlank orElseThrow canBeEmpty allowNullValues isReadOnly sortByName mapToObject
HttpServletRequest AbstractFactoryBean ConcurrentHashMap BufferedInputStream NullPointerException IllegalArgumentException
background-color border-top-left-radius font-family text-decoration margin-bottom content-type accept-encoding user-agent
internationalization responsibilities characterization misunderstanding recommendations telecommunications
Geschwindigkeitsbegrenzung Rechtsschutzversicherungsgesellschaften Unabhaengigkeitserklaerung Verantwortlichkeiten
anticonstitutionnellement gouvernementalisation developpement representants independamment
desafortunadamente internacionalizacion responsabilidades caracteristicas administraciones
test_case_number_12 version_2_release_3 chapter-10-section-4 figure_15_caption page-2021-03-14 build-2024-11-30-final
invoice_2023_0001 report-q3-2022 img_20230415_103000 backup-2020-01-01 order_100045 room-101 python3 utf8 sha256 base64
the_quick_brown_fox_jumps_over_the_lazy_dog hello_world_example this-is-a-long-article-title-about-nothing
how-to-install-and-configure-the-server release-notes-for-version-10 frequently-asked-questions terms-and-conditions
README CONTRIBUTING CHANGELOG LICENSE MAX_VALUE DEFAULT_BUFFER_SIZE ENVIRONMENT_VARIABLE_NAME HTTP_STATUS_NOT_FOUND
www.example.com/articles/how-to-bake-bread.html www.example.org/index.php docs.python.org/3/library/functions.html
news.example.net/2023/04/15/local-news-of-the-day.html blog.example.com/posts/2021/11/a-walk-in-the-park/ github.com/example/project
/usr/local/lib/python3.11/site-packages/numpy/core/__init__.py /home/user/documents/report_final.pdf /var/log/syslog.1 src/main/java/com/example/App.java
../images/photo_001.jpg config/settings.yaml data/input/customers_2022.csv ./configure.sh Makefile.am index.html style.css jquery.min.js
john.smith mary.jones info support sales.department webmaster anna-maria.schmidt jean-pierre.dupont
12345678 20230415 2021-03-14 1999-12-31 19.99 1.000.000 3.14159265 192.168.0.1 10.0.0.255 127.0.0.1 0800-555-0199 555-0142 +49-30-901820 +1-202-555-0173
100000000 1234567890 4711 2023-04-15 01.02.2003 31.12.1999 1/2 3/4 24/7 2022/2023 10:30 1.2.3 2.0.1 4.5.6-beta v1.10.2 v2.0.0-rc1
and/or his/her yes/no input/output client/server read/write e.g. i.e. etc. ... ---- ====== -------- ______ ======== .......... --help --version -verbose
well-known state-of-the-art mother-in-law up-to-date long-term high-quality user-friendly end.The sentence.Then word.Next
a=b x=1 width=100 height=200 name=value key=value color=red page=2 id=42 lang=en i+1 n-1 a+b c++ x86_64 i386 amd64 iso-8859-1 utf-8 h264 mp3 mpeg4
heureux nombreux beaux vieux yeux deux lieux feux cheveux peureux eaux chevaux tableaux nouveaux veuve fauteuil aujourd maison pourquoi toujours
poema oeste doescribir bohemio leones desde entonces siempre trabajo izquierda azul lapiz feliz cruz gallego llamar llegar guerra zapato quizas
Kopfschmerzen Pfennig empfinden Apfel doch Schloss zwischen Zukunft Jahrhundert wichtig Quelle bequem jetzt Fuchs Hexe Boxer
whether somewhere awhile whichever threshold rhythm length strengths ought queue quite equal jazz exact example mixture
the_of_and thereabouts neighbourhood understanding throughout something everything international government development information
""".split()

CLASS_OF = {**dict.fromkeys(ALPHABET[:26], 0), **dict.fromkeys(ALPHABET[26:52], 1), **dict.fromkeys(ALPHABET[52:62], 2), **dict.fromkeys(ALPHABET[62:], 3)}


def random_strings(n: int = SAMPLES) -> list[str]:
    """Labelled random strings by rule: digests in hexadecimal of both cases, both base 64 alphabets, base 36 and base 62."""
    import base64
    out = []
    for i in range(n):
        d = hashlib.sha256(f"random string {i}".encode()).digest()
        x = int.from_bytes(d, "big")
        out.append(d[:20].hex() if i % 2 else d[:20].hex().upper())
        out.append(base64.urlsafe_b64encode(d[:30]).decode())
        out.append(base64.b64encode(d[:31 - i % 2]).decode())
        out.append("".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[x // 36 ** k % 36] for k in range(24)))
        out.append("".join("abcdefghijklmnopqrstuvwxyz0123456789"[x // 36 ** k % 36] for k in range(24)))
        out += ["".join(ALPHABET[(x >> shift) // 62 ** k % 62] for k in range(20)) for shift in (0, 120)]
    return out


def transition_logs(samples: list[str], backoff: float = BACKOFF) -> list[list[float]]:
    """Log probabilities of the next character given the last: counted
    transitions, smoothed by those between classes (lower case, upper case,
    digits, others), uniform within a class."""
    k, sizes = len(ALPHABET), [26, 26, 10, len(ALPHABET) - 62]
    counts, classes = [[0.0] * k for _ in range(k)], [[1.0] * 4 for _ in range(4)]
    for s in samples:
        codes = [ALPHABET.index(c) for c in s if c in ALPHABET]
        for a, b in zip(codes, codes[1:], strict=False):
            counts[a][b] += 1
            classes[CLASS_OF[ALPHABET[a]]][CLASS_OF[ALPHABET[b]]] += 1
    out = []
    for a, row in enumerate(counts):
        own = classes[CLASS_OF[ALPHABET[a]]]
        prior = [own[CLASS_OF[c]] / sum(own) / sizes[CLASS_OF[c]] for c in ALPHABET]
        out.append([math.log((x + backoff * p) / (sum(row) + backoff)) for x, p in zip(row, prior, strict=True)])
    return out


def log_ratios(random: list[str] | None = None, ordinary: list[str] | None = None) -> list[float]:
    """log P(next | last, random) - log P(next | last, ordinary), row by row."""
    words = ordinary or ORDINARY
    r = transition_logs(random or random_strings())
    o = transition_logs([*words, *(w.lower() for w in words), *(w.upper() for w in words if w.isalpha())])
    return [x - y for rr, oo in zip(r, o, strict=True) for x, y in zip(rr, oo, strict=True)]


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """array<struct<start, end, kind, value>> of all matches, in order."""
    def located(x: Column) -> Column:
        sizes = F.transform(x["found"], F.length)
        steps = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(sizes)), sizes, lambda g, n: F.length(g) + n)
        return F.zip_with(prefix_sums(steps), x["found"], lambda end, v: F.struct(
            (end - F.length(v)).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), v.alias("value")))

    pair = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    none = F.array().cast("array<struct<start:long,end:long,kind:string,value:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), bound(pair, located)).otherwise(none)


def _excess(token: Column, table_: Column, threshold: tuple[float, float]) -> Column:
    """Summed log-likelihood ratio of a token's transitions, less what a token of its length needs."""
    def summed(codes: Column) -> Column:
        steps = F.transform(F.slice(codes, F.lit(2), F.size(codes)), lambda c, i: F.get(table_, F.get(codes, i) * len(ALPHABET) + c))
        return F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) - (threshold[0] + F.size(codes) * threshold[1])
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return bound(codes, summed)


def scan(docs: DataFrame, threshold: tuple[float, float] = THRESHOLD, ratios: list[float] | None = None) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, end, kind, value), by start
    and then by kind as listed; ``spans`` also has the ``markov`` ones."""
    weights = constant_array(ratios or log_ratios(), "double")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))

    def of_kind(kind: str, pattern: str, group: int, least: int) -> Column:
        return F.filter(_spans(F.col("t"), kind, pattern),
                        lambda s: F.length(F.regexp_extract(s["value"], pattern, group)) >= least).alias(kind)

    def random(token: Column) -> Column:
        return _excess(token, weights, threshold) > 0

    # every candidate is scored once; places are only worked out for texts that have a random one
    tokens = F.array_distinct(F.regexp_extract_all("t", F.lit(TOKEN), F.lit(0)))
    found = rows.select("doc_id", "t", F.exists(tokens, random).alias("some"), *[of_kind(kind, *rule) for kind, rule in KINDS.items()])
    names = list(KINDS)
    rank = {k: i for i, k in enumerate([*names, "markov"])}

    def ranked(spans: Column, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank[kind]).alias("rank"), s["end"].alias("end"),
                                                     s["kind"].alias("kind"), s["value"].alias("value")))

    base = found.select("doc_id", "t", "some", F.sort_array(F.concat(*[ranked(F.col(k), k) for k in names])).alias("base"))
    free = F.filter(F.filter(_spans(F.col("t"), "markov", TOKEN), lambda s: random(s["value"])),
                    lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    more = F.sort_array(F.concat("base", ranked(free, "markov")))
    return base.select("doc_id", "base", F.when(F.col("some"), more).otherwise(F.col("base")).alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_secrets(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    count = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
