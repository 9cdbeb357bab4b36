import pytest
from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.functions.translit import romanise, to_ascii
from tessella.sources import tables


def apply(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in to_ascii(df, "s").select("i", f(F.col("s")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("F0ods", "foods"), ("002050", "2050"), ("2Nd Floor", "2 floor"), ("158ND", "158"), ("Shop4", "shop 4"), ("One Two Three", "1 2 3"), ("AT&T", "at and t"),
        ('"ehpad Club SAS"', "ehpad club sas"), ("Société Générale", "societe generale"), ("a0b0c", "aoboc"), ("000", "0"), ("...", ""), ("Straße", "strasse"), (None, ""),
    ],
)
def test_normalize(spark, given, want):
    assert apply(spark, T.normalize, given) == [want]


def test_names(spark):
    core = lambda s: T.core_name(T.normalize(s))
    names = ("Tata Consultancy Services Ltd", "Acme Pvt Ltd", "Ltd", "Marina Ecole France Sarl", "")
    assert apply(spark, core, *names) == ["tata consultancy services", "acme", "ltd", "marina ecole france", ""]


def test_addresses(spark):
    assert apply(spark, T.address_words, "1st Street", "2Nd Floor") == [["1", "st"], ["2", "fl"]]
    assert apply(spark, lambda s: T.numbers_of(T.tokens(s)), "0000000305/1A") == [["305", "1"]]
    assert apply(spark, lambda s: T.number_pairs_of(T.address_words(s)), "203 26th Street", "", "7") == [["203_26", "26_st"], [], []]


def test_skeletons(spark):
    words = ("tirupti", "tirupati", "pharma", "bright", "finance", "inc", "2200", "aeiou")
    assert apply(spark, T.skeleton, *words) == ["trpt", "trpt", "frn", "brt", "fns", "ns", "20", ""]
    two = apply(spark, lambda s: T.skeleton_text(T.normalize(s)), "तिरुपति फाइनेंस", "Tirupati Finance")
    assert two[0] == two[1] == "trpt fns"


def test_romanise():
    assert romanise("Москва") == "Moskva"
    assert romanise("Αθηνα") == "Athina"
    assert romanise("१२ अ") == "12 a" and romanise("") == ""
    # Letters of different scripts share names.
    assert romanise("ハナ") == "hana" and romanise("かべ") == "kabe" and romanise("しつ") == "shitsu" and romanise("ラーメン") == "ramen"
    assert romanise("서울") == "seoul" and romanise("부산 한국") == "busan hanguk"
    # Han characters and marks stay; normalisation splits at them.
    assert romanise("東京 a—b") == "東京 a—b"


def test_read_tsv(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"""ehpad Club SAS"\t"110, MG Road, Pune"\tFR\nS2-2\tN/A\t\tIN\nS3-3\tshort\n', encoding="utf-8")
    rows = {r.entity_id: r for r in tables.read_records(spark, str(path)).collect()}
    assert rows["S1-1"].business_name == '"ehpad Club SAS' and rows["S1-1"].business_address == "110, MG Road, Pune"
    assert rows["S2-2"].business_name == "N/A" and rows["S2-2"].business_address == ""
    assert rows["S3-3"].country == ""
    assert [r.e for r in tables.read_records(spark, str(path)).select(tables.encoded_id(F.col("entity_id")).alias("e")).collect()] == [10**13 + 1, 2 * 10**13 + 2, 3 * 10**13 + 3]
