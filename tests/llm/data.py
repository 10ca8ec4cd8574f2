"""Small fixtures: given rows plus the defined edge cases."""

import random
import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, n_tokens string, rep long, kept int"


def words(text):
    return WORD.findall(text or "")


def edge_docs(spark):
    """Nulls in every column, empty and very long texts, copies, near copies, a shared passage, names that clash."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base, passage = prose(120), prose(40)
    near = base.split(" ")
    near[60] = "changed"
    texts = [None, "", " \n\t ", "one", "four little words here", base, base, " ".join(near), base.upper(), f"{prose(30)} {passage} {prose(30)}", f"{prose(25)}\n{passage}\n{prose(9)}",
             f"{passage} {passage}", prose(30_000), "é日本 <|endoftext|> ok's x", "line a b c d e\nline a b c d e\nline a b c d e", prose(13), "# $ % & | < > * # $ % &", prose(200)]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None, "")[i % 4], None, 7, "x", 3, 1) for i, t in enumerate(texts)]
    rows += [rows[5], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def both(spark):
    """The edge cases beside the given documents."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    return edge_docs(spark).unionByName(given.selectExpr("doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars"), allowMissingColumns=True)
