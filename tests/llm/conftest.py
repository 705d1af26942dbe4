import random

import duckdb
import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        T.StructField("score", T.DoubleType()),
        T.StructField("words", T.StringType()),
        T.StructField("rank", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("_col1", T.StringType()),
    ]
)
PAGES = "page_id long, url string, html string, host string, digest string"
VOCABULARY = [
    a + b for a in ("ta", "ro", "mi", "kel", "sun", "dor", "vi", "pa") for b in ("n", "ra", "lo", "sti", "ek", "ü")
]
INSULT = "idiot"


def sentence(rng, words):
    return " ".join(rng.choice(VOCABULARY) for _ in range(words)) + "."


def prose(rng, lines=6, words=25):
    return "\n".join(sentence(rng, words) for _ in range(lines))


def benchmark_items():
    rng = random.Random(7)
    return [(i, sentence(rng, 18 + 6 * i)) for i in range(6)]


def documents():
    """Plain prose and, from id 100 on, one case of every kind that may go wrong."""
    rng = random.Random(1)
    texts = {i: prose(rng) for i in range(60)}
    passage = sentence(rng, 60)
    for i in range(10, 20):
        texts[i] += "\n" + passage
    for i in range(3, 60, 4):
        texts[i] += f"\nYou {INSULT}, " + sentence(rng, 5)
    for i in range(0, 60):
        texts[i] += "\nAll rights are kept."
    leak = benchmark_items()
    texts |= {
        100: texts[0],
        101: texts[0],
        102: texts[1].replace(texts[1].split()[40], "changed"),
        103: None,
        104: "",
        105: " \n\t\n ",
        106: "one",
        107: "two words",
        108: prose(rng, 1500, 12),
        109: "x" * 300_000,
        110: texts[2] + "\n" + leak[2][1],
        111: leak[1][1].upper().replace(" ", "  "),
        112: " ".join(w if i % 9 else "other" for i, w in enumerate(leak[4][1].split())),
        113: "a  b   c \n d\n\n  e <|endoftext|> f 1234abc ' 's \u00a0 \u3000 日本語 🙂 e\u0301",
        114: "same same same same same same same same\n" * 12,
        115: "#a *b $c %d &e |f <g> h\r\n\x0b\x0cEnd\x1c of\x85 words",
        116: leak[0][1],
        117: "İstanbul ΣΑΣ straße",
    }
    rows = [(i, text) for i, text in texts.items()]
    rows += [(None, texts[5]), (None, None), (7, texts[7]), (7, texts[7]), (8, "another text of eight")]
    rows += [(200 + i, texts[9]) for i in range(40)]
    names = ["src0", "src1", None]
    return [
        (i, text, "en", names[k % 3] if k % 2 else "src0", None if text is None else len(text), 0.5, "w", 1, 2, "c")
        for k, (i, text) in enumerate(rows)
    ]


def pages():
    long = "<p>" + "a long page " * 200 + "</p>"
    link = '<a href="https://{}/x">x</a>'
    rows = [
        (1, "https://a.example.net/en/1", long),
        (2, "https://a.example.net/de/1?x", long),
        (3, "http://B.Example.COM/de/2#t", long + "!"),
        (4, "https://c.example.org/fr/", "short"),
        (5, "https://c.example.org/fr", "short"),
        (6, "no scheme/de/", None),
        (7, None, ""),
        (8, "https://net/", link.format("bad.net") + link.format("bad.net")),
        (9, "https://linker.info/a", link.format("bad.net") + link.format("Worse.NET")),
        (10, "https://friend.info/", link.format("good.org")),
        (11, "https://bad.net/index", link.format("linker.info")),
        (12, "https://worse.net/index", "<a href=//linker.info/>x</a>"),
        (13, "https://good.org/fr/1", link.format("fine.info:80") + link.format("friend.info")),
        (14, "https://example.net", "x"),
        (15, "https://fine.info:80/", ""),
        (16, "x://a?b://c", "y"),
        (17, "https://new\nline.org/fr/a\nb", "z"),
        (None, "https://d.example.com/de/", long),
        (2, "https://a.example.net/de/1?x", long),
    ]
    return [(*row, "clash", "clash") for row in rows]


def write(spark, folder, empty=False):
    def save(name, rows, schema):
        rows = [] if empty else rows
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")

    docs = documents()
    save("documents", docs, DOCS)
    save("pages", pages(), PAGES)
    save("benchmark", [*benchmark_items(), (6, None), (7, ""), (8, "two words"), (0, benchmark_items()[0][1])],
         "item_id long, text string")
    known = {i: text for i, text, *_ in docs if i is not None and i < 60}
    save("labels", [(i, 1, int(INSULT in text)) for i, text in known.items()] + [(None, 1, 1), (3, 0, None)],
         "doc_id long, quality int, toxic int")
    return str(folder)


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("edge"))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), empty=True)


@pytest.fixture(scope="session")
def docs():
    return [(row[0], row[1]) for row in documents()]


@pytest.fixture(scope="session")
def sql(edge):
    """Runs SQL over the edge tables in DuckDB."""
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.sql(f"create view {name} as select * from read_parquet('{edge}/{name}.parquet/*.parquet')")
    return connection.sql


def sorted_rows(rows):
    return sorted((tuple(row) for row in rows), key=repr)
