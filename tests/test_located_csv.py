"""Header-driven, located scan of delimited files against Python's csv module."""

import csv
import io
import random

import pytest

from fixtures import base_tables
from kubus.operators import dims as D
from kubus.operators import facts as FT
from kubus.sources import located_csv
from kubus.sources.located_csv import ends_inside, read_located_csv
from kubus.sources.sales_text import SALES_COLUMNS, read_sales_csv

COLUMNS = ("Date", "Shop", "Article")


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plain(path, encoding="ISO-8859-1"):
    """(values by name, first line) of every record, by Python's csv module."""
    text = path.read_text(encoding=encoding)
    reader = csv.reader(io.StringIO(text, newline=""), delimiter=";")
    out, names, begin = [], None, 1
    for row in reader:
        first, begin = begin, reader.line_num + 1
        if names is None:
            names = row
        elif row:
            named = dict(zip(names, row)) | dict.fromkeys(names[len(row):])
            out.append((path.name, first, *[named.get(c) for c in COLUMNS]))
    return out


def read(spark, folder):
    rows = read_located_csv(spark, str(folder), COLUMNS).collect()
    return sorted((r["source_file"].rsplit("/", 1)[1], r["source_line"], *[r[c] for c in COLUMNS])
                  for r in rows)


def same(found, expected):
    """Unquoted empty fields are null here and empty text there."""
    blank = [tuple("" if v is None else v for v in r) for r in found]
    assert blank == sorted(tuple("" if v is None else v for v in r) for r in expected)


def test_fields_by_name_over_many_splits(small_splits, tmp_path):
    r = random.Random(1)
    orders = [["Date", "Shop", "Article"], ["Shop", "Date", "Article"], ["x", "Article", "Date", "Shop", "y"],
              ["Date", "Article"], ["Shop", "Date", "Shop", "Article"]]
    for i, names in enumerate(orders):
        lines = [";".join(names)]
        for n in range(150):
            fields = [f"{c}{n} {r.choice(['ü', 'ß', 'a', ''])}".strip() for c in names]
            lines.append(";".join(fields[:r.choice([len(names)] * 4 + [1])] + ["more"] * r.choice([0, 0, 1])))
            if n % 31 == 0:
                lines.append("")
        (tmp_path / f"f{i}.csv").write_bytes(("\r\n" if i % 2 else "\n").join(lines).encode("ISO-8859-1"))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("Date;Shop;Article\n")
    found = read(small_splits, tmp_path)
    same(found, [x for f in tmp_path.glob("f*.csv") for x in plain(f)])
    assert small_splits.read.text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_quoted_breaks_over_many_splits(small_splits, tmp_path):
    r = random.Random(2)
    for i in range(4):
        out = io.StringIO()
        writer = csv.writer(out, delimiter=";", lineterminator="\n")
        writer.writerow(["Shop", "Date", "Article"] if i % 2 else ["Date", "Shop", "Article"])
        for n in range(120):
            writer.writerow([r.choice([f"plain {n}", "24\" wide" if i < 2 else "x", 'say "hi"; now', f"two\nlines {n}",
                                       "many\n\n" + "lines\n" * r.randint(1, 60) if n % 29 == 0 else "short",
                                       '"', "a\n", "\n\"b\""]) for _ in range(3)])
        (tmp_path / f"q{i}.csv").write_text(out.getvalue(), encoding="ISO-8859-1")
    (tmp_path / "inch.csv").write_text('Date;Shop;Article\n1;2;24" screen\n3;4;5" disk; \n', encoding="ISO-8859-1")
    same(read(small_splits, tmp_path), [x for f in tmp_path.glob("*.csv") for x in plain(f)])


def test_line_ends_as_the_csv_module_sees_them():
    r = random.Random(4)
    for _ in range(3000):
        line = "".join(r.choice('";ab') for _ in range(r.randint(0, 9)))
        # Two records come out of the first text exactly if the quotes are closed.
        for inside in (False, True):
            text = ('"' if inside else "") + line + "\nend"
            rows = list(csv.reader(io.StringIO(text), delimiter=";"))
            assert ends_inside(line, inside, ";") == (len(rows) == 1), (line, inside)


def test_native_pattern_agrees_with_the_scanner(spark):
    r = random.Random(5)
    lines = ["".join(r.choice('";ab') for _ in range(r.randint(0, 9))) for _ in range(3000)]
    lines += ['"' + "x" * 50000 + '"', '"' + 'y""' * 20000, "z;" * 20000 + '"']
    pattern = located_csv._complete(";")
    found = spark.createDataFrame([(x,) for x in lines], "line string") \
        .selectExpr("line", f"NOT line RLIKE r'{pattern}' AS opens").collect()
    for row in found:
        assert row["opens"] == ends_inside(row["line"], False, ";"), row["line"][:20]


def test_unclosed_quote_is_read_line_by_line(small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(located_csv, "MAX_RECORD_CHARS", 40)
    (tmp_path / "u.csv").write_text('Date;Shop;Article\n1;2;3\n4;"5;6\n' + "\n".join(f"{i};b;c" for i in range(7, 30)))
    found = read(small_splits, tmp_path)
    assert [f[1] for f in found] == list(range(2, 27)) and found[0][2:] == ("1", "2", "3")
    assert found[5][2:] == ("10", "b", "c")


def test_rejects_know_file_and_line(small_splits, tmp_path):
    spark = small_splits
    t = base_tables(spark)
    shop = D.shop_dimension(t["shop"], t["city"], t["region"], t["country"])
    product = D.product_dimension(t["article"], t["group"], t["family"], t["category"])
    good = {"Date": "03.04.2019", "Shop": "Superstore Kiel", "Article": "Brill 28 VE/RL", "Sold": "1",
            "Revenue": "139,00"}
    bad = {3: ("Date", "31.02.2019", "bad_date"), 50: ("Shop", "none", "unknown_shop"),
           99: ("Article", "none", "unknown_article"), 100: ("Revenue", "x", "bad_revenue"),
           140: ("Sold", "", "bad_sold")}
    names = {"a.csv": SALES_COLUMNS, "b.csv": ("Sold", "Revenue", "Shop", "Date", "Article")}
    for name, columns in names.items():
        lines = [";".join(columns)]
        for n in range(2, 160):
            row = dict(good)
            if n in bad:
                row[bad[n][0]] = bad[n][1]
            lines.append(";".join(row[c] for c in columns))
        (tmp_path / name).write_text("\n".join(lines), encoding="ISO-8859-1")
    (tmp_path / "c.csv").write_text("Date;Shop;Article;Sold\n03.04.2019;Superstore Kiel;Brill 28 VE/RL;1\n")
    classified = FT.classify_sales(read_sales_csv(spark, str(tmp_path)), shop, product, D.calendar(spark))
    found = {(r["source_file"].rsplit("/", 1)[1], r["source_line"]): r["reject_reason"]
             for r in FT.rejected(classified).collect()}
    assert found == {(f, n): b[2] for f in names for n, b in bad.items()} | {("c.csv", 2): "bad_revenue"}
    assert FT.accepted(classified).count() == 2 * (158 - len(bad))
