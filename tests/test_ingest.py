import os
import random
import re
import stat
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import CARS, PEOPLE, SALE, STORES
from pyspark.sql import functions as F
from tallysieve import fixed_values as fv
from tallysieve.errors import ArchiveError, ConflictError, DelimitedError, InputError
from tallysieve.operators import explore
from tallysieve.plans.run import run_batch
from tallysieve.sinks import exports, publish, raw_files, retention, search_index
from tallysieve.sinks.staging import Staging
from tallysieve.sources import archives, delimited, listing, published, ranges, stores
from tallysieve.sources.batch import read_batch


def text_of(name, rows):
    return "\r\n".join(";".join(r) for r in [fv.CONTRACT_COLUMNS[name], *rows]) + "\r\n"


SALES_ROWS = [tuple({**SALE, **c}.values()) for c in (
    {"data_venda": "2025-01-10"},
    {"venda_id": "S2", "data_venda": "2025-01-20", "veiculo_id": "V2", "valor_referencia": "1000", "valor_venda": "950"},
    {"venda_id": "S3", "data_venda": "2025-02-10", "veiculo_id": "V3", "loja_id": "L2", "consultor_id": "C2",
     "valor_referencia": "200", "valor_venda": "250"},
    {"venda_id": "S4", "veiculo_id": "V404"},
)]
FILES = {
    "dados/vendas/vendas_2025_01.csv": text_of("vendas", SALES_ROWS),
    "dados/dimensoes/dim_veiculos.csv": text_of("veiculos", CARS),
    "dados/dimensoes/dim_lojas.csv": "\ufeff" + text_of("lojas", STORES),
    "dados/dimensoes/dim_consultores.csv": text_of("consultores", PEOPLE),
    "README.md": "# texto",
}


def write_zip(path, files=FILES, change=None):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files.items():
            info = zipfile.ZipInfo(name)
            info.compress_type = zipfile.ZIP_DEFLATED
            if change:
                change(info)
            z.writestr(info, content)
    return str(path)


def write_folder(root, files):
    for name, content in files.items():
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(root)


def test_folder_keeps_text_and_lines(spark, tmp_path):
    sales = text_of("vendas", [tuple({**SALE, "valor_venda": v}.values()) for v in ("000123,40", "NA", "")])
    people = text_of("consultores", []) + '"C1";"Ana\nMaria";L1;A;""\r\nC2;B;L1;A;2020-01-01\r\n'
    batch = read_batch(spark, write_folder(tmp_path / "in", {"vendas_2025.csv": sales, "x/dim_consultores.csv": people, "README.md": "x"}))
    rows = batch.table("vendas").orderBy("__source_line").collect()
    assert [(r["valor_venda"], r["__source_line"]) for r in rows] == [("000123,40", 2), ("NA", 3), ("", 4)]
    people = batch.table("consultores").orderBy("__source_line").collect()
    assert [(r["consultor"], r["data_admissao"], r["__source_line"]) for r in people] == [("Ana\nMaria", "", 2), ("B", "2020-01-01", 4)]
    assert [(r["source_file"], r["rows"]) for r in batch.summary().collect()] == [("vendas_2025.csv", 3), ("x/dim_consultores.csv", 2)]
    with pytest.raises(InputError, match="no table of contract"):
        batch.tables()


def test_unknown_name_is_matched_by_header(spark, tmp_path):
    batch = read_batch(spark, write_folder(tmp_path / "in", {"qualquer.csv": text_of("lojas", STORES)}))
    assert batch.table("lojas").count() == 2
    single = read_batch(spark, str(tmp_path / "in" / "qualquer.csv"))
    assert single.table("lojas").collect()[0]["__source_file"] == "qualquer.csv"


HEADER = ";".join(fv.CONTRACT_COLUMNS["lojas"])
BAD = {
    "missing": "loja_id;loja;cidade;uf\n",
    "extra": HEADER + ";x\n",
    "order": "loja;loja_id;cidade;uf;cluster\n",
    "repeated": "loja_id;loja;cidade;uf;uf\n",
    "trailing blank": HEADER + " \n",
    "comma": HEADER.replace(";", ",") + "\n",
    "utf16": (HEADER + "\n").encode("utf-16"),
    "utf32": (HEADER + "\n").encode("utf-32"),
    "cp1252": (HEADER + "\nL1;São;x;AM;A\n").encode("cp1252"),
    "nul": HEADER + "\nL1;a\0;x;AM;A\n",
    "short row": HEADER + "\nL1;a;x;AM\n",
    "blank line": HEADER + "\n\nL1;a;x;AM;A\n",
    "bad quotes": HEADER + '\nL1;"a"b;x;AM;A\n',
}


@pytest.mark.parametrize("case", BAD)
def test_bad_files_refuse_the_batch(spark, tmp_path, case):
    with pytest.raises(DelimitedError, match="dim_lojas.csv"):
        read_batch(spark, write_folder(tmp_path / "in", {"dim_lojas.csv": BAD[case]}))


def test_unexpected_empty_and_oversized_files(spark, tmp_path):
    with pytest.raises(InputError, match="unexpected file"):
        read_batch(spark, write_folder(tmp_path / "a", {"x.txt": "x"}))
    with pytest.raises(InputError, match="empty file"):
        read_batch(spark, write_folder(tmp_path / "b", {"dim_lojas.csv": ""}))
    with pytest.raises(InputError, match="no such input"):
        read_batch(spark, str(tmp_path / "none"))
    folder = write_folder(tmp_path / "c", {"x/dim_lojas.csv": text_of("lojas", STORES)})
    for limits, message in (
        (listing.Limits(entries=1), "too many entries"), (listing.Limits(file_bytes=3), "file over"),
        (listing.Limits(total_bytes=3), "total size"),
    ):
        with pytest.raises(InputError, match=message):
            read_batch(spark, folder, limits)


def whole_rows(spark, root):
    """Rows of all files as one strict reader per file gives them."""
    rows = [(p.relative_to(root).as_posix(), None, p.read_bytes()) for p in sorted(root.rglob("*.csv"))]
    files = spark.createDataFrame(rows, "source_file string, schema_hint string, content binary")
    return sorted((r["source_file"], r["line"], r["fields"], r["encoding"], r["problem"]) for r in delimited.parse_files(files).collect())


def ranged_rows(spark, root, size, stage):
    files = listing.list_files(spark, str(root), stage).where("kind = 'file'").withColumn("schema_hint", F.lit(None).cast("string"))
    _, parsed = ranges.read_ranged(files, stage, size=size)
    return sorted((r["source_file"], r["line"], r["fields"], r["encoding"], r["problem"]) for r in parsed.collect())


ODD = ["", "plain", 'a"b', '"', '""', ";", "x\ny", "\n", "\r\n", "\r", "é中😀", '";"', 'say ""hi""\r\n;', " ", '"""', "z" * 90]


@pytest.mark.parametrize("size", [1, 17, 400])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, monkeypatch, size):
    """Quotes, line breaks and characters across every border, in names with blanks."""
    monkeypatch.setattr(ranges, "MAX_TASKS", 4)
    rng = random.Random(size)
    root = tmp_path / "in put"
    (root / "b c").mkdir(parents=True)
    for number, name in enumerate(("uma loja.csv", "b c/minha%20loja.csv", "b c/_x.csv")):
        text = [";".join(fv.CONTRACT_COLUMNS["lojas"])]
        for _ in range(25 if size == 1 else 250):
            fields = [rng.choice(ODD) for _ in range(5)]
            quoted = [f'"{f.replace(chr(34), chr(34) * 2)}"' if set(f) & set(';"\r\n') or rng.random() < 0.2 else f for f in fields]
            text.append(";".join(quoted))
        ends = rng.choice(["\n", "\r\n", "\r"])
        content = ("\ufeff" if number == 1 else "") + ends.join(text) + (ends if number else "")
        (root / name).write_bytes(content.encode())
    found = ranged_rows(spark, root, size, Staging(spark))
    assert found == whole_rows(spark, root)
    assert len({f[0] for f in found}) == 3 and all(f[4] is None for f in found)


def test_one_field_over_many_ranges(spark, tmp_path):
    root = tmp_path / "in"
    long = "L1;\"" + "line\n" * 20_000 + "\";x;AM;A\nL2;b;x;AM;A\n"
    write_folder(root, {"dim_lojas.csv": HEADER + "\n" + long, "quotes.csv": HEADER + "\nL1;" + '"' * 20_000 + ";x;AM;A\n"})
    assert ranged_rows(spark, root, 9000, Staging(spark)) == whole_rows(spark, root)


def test_many_tasks_read_one_file(spark, tmp_path):
    rows = [(f"L{i}", '"loja\n;"', "cidade", "AM", "A") for i in range(5000)]
    folder = write_folder(tmp_path / "in", {"dim_lojas.csv": text_of("lojas", rows)})
    table = read_batch(spark, folder, range_bytes=10_000).table("lojas")
    assert table.select(F.min("__source_line"), F.max("__source_line"), F.count("*")).collect()[0] == (2, 10_000, 5000)
    assert table.where("loja <> 'loja\n;'").count() == 0
    files = listing.list_files(spark, folder).where("kind = 'file'")
    assert ranges.byte_ranges(files, 10_000).count() > 10


def test_first_problem_of_a_ranged_file(spark, tmp_path):
    for case, bad in {"line 2: 4 fields": "L1;a;x;AM\n", 'line 3: .*expected after': 'L0;a;x;AM;A\nL1;"a"b;x;AM;A\n', "unexpected end": 'L1;"a;x;AM;A\n' * 3}.items():
        folder = write_folder(tmp_path / str(len(bad)), {"dim_lojas.csv": HEADER + "\n" + bad})
        with pytest.raises(DelimitedError, match=case):
            read_batch(spark, folder, range_bytes=16)


def test_bytes_are_checked_across_borders(spark, tmp_path):
    for case, content in {"not UTF-8": b"L1;" + b"\xe4\xb8\xad" * 20 + b"\xb8;x;AM;A\n", "binary content": b"L1;" + b"a" * 50 + b"\0;x;AM;A\n"}.items():
        folder = write_folder(tmp_path / case[:3], {"dim_lojas.csv": HEADER.encode() + b"\n" + content})
        with pytest.raises(DelimitedError, match=case):
            read_batch(spark, folder, range_bytes=7)
    sound = write_folder(tmp_path / "sound", {"dim_lojas.csv": HEADER + "\nL1;" + "中é😀" * 20 + ";x;AM;A\n"})
    assert read_batch(spark, sound, range_bytes=7).table("lojas").collect()[0]["loja"] == "中é😀" * 20
    with pytest.raises(DelimitedError, match="no header line"):
        read_batch(spark, write_folder(tmp_path / "long", {"dim_lojas.csv": "x;" * ranges.HEADER_BYTES}))


def test_hidden_names_empty_folders_and_links(spark, tmp_path):
    folder = tmp_path / "in"
    write_folder(folder, {"_extra.csv": text_of("lojas", STORES), ".hidden.csv": text_of("lojas", STORES), "README.md": "x", "a/.gitkeep": ""})
    (folder / "empty" / "within").mkdir(parents=True)
    found = {r["source_file"]: (r["kind"], r["skipped"]) for r in listing.list_files(spark, str(folder)).collect()}
    assert found == {
        "_extra.csv": ("file", False), ".hidden.csv": ("file", False), "README.md": ("file", True), "a": ("folder", False),
        "a/.gitkeep": ("file", True), "empty": ("folder", False), "empty/within": ("folder", False),
    }
    assert read_batch(spark, str(folder)).table("lojas").count() == 4
    with pytest.raises(InputError, match="too many entries"):
        read_batch(spark, str(folder), listing.Limits(entries=6))
    for name in (".bad.exe", ".csv", "_SUCCESS"):
        (folder / name).write_text("x")
        with pytest.raises(InputError, match=f"{re.escape(name)}: unexpected file"):
            read_batch(spark, str(folder))
        (folder / name).unlink()
    (folder / "to").symlink_to(folder / "empty")
    with pytest.raises(InputError, match="to: link"):
        read_batch(spark, str(folder))
    with pytest.raises(InputError, match="no delimited file"):
        read_batch(spark, str(folder / "empty"))


def test_spark_only_stores_are_read_whole(spark, tmp_path, monkeypatch):
    """Where tasks cannot open files, Spark's file source reads the same rows."""
    folder = write_folder(tmp_path / "in", {"x/dim_lojas.csv": text_of("lojas", STORES), "README.md": "x"})
    ours = read_batch(spark, folder).table("lojas").collect()
    monkeypatch.setattr(stores, "opens", lambda path: False)
    assert read_batch(spark, folder).table("lojas").collect() == ours
    assert {(r["source_file"], r["kind"]) for r in listing.list_files(spark, folder).collect()} == {("x", "folder"), ("x/dim_lojas.csv", "file"), ("README.md", "file")}
    with pytest.raises(InputError, match="no such input"):
        read_batch(spark, str(tmp_path / "none"))


def test_summary_has_headers_and_totals(spark, tmp_path):
    folder = write_folder(tmp_path / "in", {"dim_lojas.csv": "\ufeff" + text_of("lojas", STORES), "b.csv": text_of("lojas", [])})
    batch = read_batch(spark, folder)
    header = list(fv.CONTRACT_COLUMNS["lojas"])
    assert [tuple(r) for r in batch.summary().collect()] == [
        ("b.csv", "lojas", "utf-8", ";", header, 0), ("dim_lojas.csv", "lojas", "utf-8-sig", ";", header, 2),
    ]
    assert tuple(batch.totals().collect()[0]) == (2, 2)


def test_landed_files_have_their_names_and_nothing_beside(spark, tmp_path):
    files = spark.createDataFrame([("a b/_x.csv", bytearray(b"1")), ("é.zip", bytearray(b""))], "name string, content binary")
    assert {tuple(r) for r in raw_files.land_files(files, str(tmp_path / "out")).collect()} == {("a b/_x.csv", 1), ("é.zip", 0)}
    assert {p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*")} == {"a b", "a b/_x.csv", "é.zip"}


def test_files_of_any_size_are_landed_block_by_block(spark, tmp_path):
    """No file goes through a row: copies keep their bytes behind a head, and a month of several files is one archive."""
    a, b = (str(tmp_path / f"in-{k}.csv") for k in "ab")
    (tmp_path / "in-a.csv").write_bytes(b"x;y\n1;2\n" * 200_000)
    (tmp_path / "in-b.csv").write_bytes("x;y\n3;é\n".encode())
    heads = spark.createDataFrame([("c/_a.csv", bytearray(b"\xef\xbb\xbf"), a), ("b.csv", bytearray(b""), b)], "name string, head binary, path string")
    landed = {tuple(r) for r in raw_files.land_copies(heads, str(tmp_path / "out")).collect()}
    assert landed == {("c/_a.csv", 1_600_003), ("b.csv", 9)}
    assert (tmp_path / "out/c/_a.csv").read_bytes() == b"\xef\xbb\xbf" + b"x;y\n1;2\n" * 200_000
    assert {tuple(r) for r in raw_files.line_feeds(heads).collect()} == {(a, 400_000), (b, 2)}
    packages = spark.createDataFrame([("m_1.zip", "dados/m.csv", [a, b, b], "README.md")], "name string, member string, paths array<string>, extra string")
    raw_files.land_archives(packages, str(tmp_path / "zips")).collect()
    assert [p.name for p in (tmp_path / "zips").rglob("*")] == ["m_1.zip"]
    with zipfile.ZipFile(tmp_path / "zips/m_1.zip") as archive:
        assert archive.namelist() == ["dados/m.csv", "README.md"]
        assert archive.read("dados/m.csv") == b"x;y\n1;2\n" * 200_000 + "3;é\n".encode() * 2


def test_row_differences_counts_repeats_and_nulls(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), (None, 2), ("y", None)], "p string, q int")
    b = spark.createDataFrame([("x", 1), ("y", None), ("z", 2), (None, None)], "p string, q int")
    assert tuple(publish.row_differences(a, b).collect()[0]) == (2, 2)
    assert tuple(publish.row_differences(a, a.repartition(3)).collect()[0]) == (0, 0)
    assert tuple(publish.row_differences(a.limit(0), a.limit(0)).collect()[0]) == (0, 0)


def test_search_index_shuffles_words_and_no_values(spark):
    """Every piece of every value is turned to words of its file's filter before anything is shuffled."""
    pieces = spark.range(0, 200_000, 1, 4).selectExpr("'f' as file", "cast(id as string) as piece")
    words = search_index._words(pieces, "file")
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert words.count() <= search_index.BITS // 64


BAD_MEMBERS = {
    "../x.csv": "unsafe", "dados/vendas/../vendas_2025.csv": "unsafe", "./x.csv": "unsafe", "/abs.csv": "unsafe",
    "C:/x.csv": "unsafe", "payload.exe": "unexpected member", "dados/segredos.csv": "unexpected member",
    "__MACOSX/": "unexpected folder", "DADOS/VENDAS/VENDAS_2025_01.CSV": "path given twice",
}


@pytest.mark.parametrize("member", BAD_MEMBERS)
def test_bad_members_refuse_the_archive(spark, tmp_path, member):
    with pytest.raises(ArchiveError, match=BAD_MEMBERS[member]):
        read_batch(spark, write_zip(tmp_path / "a.zip", {**FILES, member: "x" if not member.endswith("/") else ""}))


@pytest.mark.parametrize(("mode", "message"), [(stat.S_IFLNK, "symbolic link"), (stat.S_IFIFO, "special file"), (stat.S_IFDIR, "folder named as file")])
def test_member_types(spark, tmp_path, mode, message):
    def change(info):
        info.external_attr = (mode | 0o644) << 16

    with pytest.raises(ArchiveError, match=message):
        read_batch(spark, write_zip(tmp_path / "a.zip", change=change))


@pytest.mark.parametrize(
    ("limits", "message"),
    [
        (listing.Limits(entries=2), "too many members"), (listing.Limits(archive_bytes=10), "archive over the size"),
        (listing.Limits(file_bytes=10), "member over the size"), (listing.Limits(total_bytes=10), "unpacked size"),
        (listing.Limits(compression_ratio=0.1), "compression ratio"),
    ],
)
def test_archive_limits(spark, tmp_path, limits, message):
    with pytest.raises(ArchiveError, match=message):
        read_batch(spark, write_zip(tmp_path / "a.zip"), limits)


def test_damaged_archives(spark, tmp_path):
    path = tmp_path / "a.zip"
    write_zip(path)
    raw = bytearray(path.read_bytes())
    raw[60:64] = b"\xff\xff\xff\xff"
    path.write_bytes(bytes(raw))
    with pytest.raises(ArchiveError):
        read_batch(spark, str(path))
    path.write_bytes(b"no archive")
    with pytest.raises(ArchiveError):
        read_batch(spark, str(path))
    write_zip(path, {"README.md": "x"})
    with pytest.raises(ArchiveError, match="no expected member"):
        read_batch(spark, str(path))


def test_encryption_and_method(spark):
    rows = [("a", 10, "dados/vendas/vendas_2025.csv", False, 5, 5, m, f, 0, None) for m, f in ((8, 1), (99, 0))]
    found = archives.member_problems(spark.createDataFrame(rows, archives.MANIFEST)).collect()
    assert {r["problem"] for r in found} >= {"path given twice, letter case aside"}
    single = [archives.member_problems(spark.createDataFrame([r], archives.MANIFEST)).collect()[0]["problem"] for r in rows]
    assert single == ["encrypted member", "compression method not allowed"]


def test_newest_archive_and_by_name(spark, tmp_path):
    for i, name in enumerate(("old.zip", "new.zip")):
        write_zip(tmp_path / name)
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    found = listing.find_batches(spark, str(tmp_path))
    assert [r["name"] for r in found.collect()] == ["new.zip", "old.zip"]
    assert listing.pick_batch(found).collect()[0]["name"] == "new.zip"
    assert listing.pick_batch(found, "old.zip").collect()[0]["name"] == "old.zip"


def published_state(spark, out):
    layer = published.open_layer(spark, out)
    mart = sorted(map(str, layer.table("mart_vendas_mensal").collect()))
    return layer, mart


def test_full_run_and_rerun(spark, tmp_path):
    source = write_zip(tmp_path / "a.zip")
    before = open(source, "rb").read()
    out, quarantine = str(tmp_path / "out"), str(tmp_path / "quarantine")
    done = run_batch(spark, source, out, quarantine)
    row = done.summary.collect()[0]
    assert (row["recebidos"], row["validos"], row["rejeitados"], row["arquivos"]) == (4, 3, 1, 4)
    layer, mart = published_state(spark, out)
    fact = layer.table("fact_vendas")
    assert len(fact.columns) == 46
    types = dict(fact.dtypes)
    assert types["valor_venda"] == "decimal(18,2)" and types["desconto_percentual"] == "decimal(9,4)"
    assert types["data_venda"] == "timestamp_ntz"
    assert fact.where("venda_id = 'S1'").collect()[0]["__source_file"] == "dados/vendas/vendas_2025_01.csv"
    assert layer.table("quality_report").count() == 20
    assert layer.volumes.collect()[0]["taxa_aprovacao"] == "75,00%"
    again = run_batch(spark, source, out, quarantine)
    second, second_mart = published_state(spark, out)
    assert second.version == again.version != layer.version
    assert mart == second_mart
    assert second.table("fact_vendas").schema == fact.schema
    assert before == open(source, "rb").read()
    cached = published.cached_sales(second)
    assert cached.count() == 3 and published.cached_sales(second) is cached
    path = exports.export_fact(spark, out, str(tmp_path / "fact_csv"))
    text = "".join(p.read_text() for p in (tmp_path / "fact_csv").glob("*.csv"))
    assert text.startswith("venda_id;data_venda;") and path.endswith("fact_csv")


def test_failed_publish_leaves_the_old_version(spark, tmp_path, monkeypatch):
    source, out = write_zip(tmp_path / "a.zip"), str(tmp_path / "out")
    run_batch(spark, source, out, str(tmp_path / "q"))
    layer, mart = published_state(spark, out)

    def broken(*_args):
        raise OSError("disk")

    monkeypatch.setattr(exports, "write_quarantine", broken)
    with pytest.raises(OSError, match="disk"):
        run_batch(spark, source, out, str(tmp_path / "q"))
    now, mart_now = published_state(spark, out)
    assert (now.version, mart_now) == (layer.version, mart)


def test_export_without_published_fact(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        exports.export_fact(spark, str(tmp_path / "none"), str(tmp_path / "csv"))


def test_month_filter_prunes_partitions(spark, tmp_path):
    from datetime import date

    from tallysieve.operators import explore

    out = str(tmp_path / "out")
    run_batch(spark, write_zip(tmp_path / "a.zip"), out, str(tmp_path / "q"))
    picked = explore.apply_selection(published.open_layer(spark, out).sales, explore.Selection(date(2025, 2, 1), date(2025, 2, 28)))
    assert [r["venda_id"] for r in picked.collect()] == ["S3"]
    assert len(picked.select("venda_id").inputFiles()) >= 1
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__mes" in plan


def stores_frame(spark, *names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "loja_id string, n int")


def test_fingerprints_know_multisets_of_rows(spark):
    rows = [("a", 1), ("b", None), (None, 2), ("b", None), (None, None)]
    frame = lambda r: spark.createDataFrame(r, "x string, y int")
    found = publish.fingerprint(frame(rows))
    assert found == publish.fingerprint(frame(rows[::-1]).repartition(3)) == publish.fingerprint(frame(rows).select("y", "x"))
    for other in (rows[:-1], [*rows, ("b", None), ("b", None)], [*rows[:-1], (None, 3)], [("a", None), ("b", 1), *rows[2:]]):
        assert publish.fingerprint(frame(other)) != found
    assert publish.fingerprint(frame([])) == {"rows": 0, "total": "0", "mixed": 0}


def test_writers_take_numbers_in_turn_and_stale_ones_are_refused(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.current_version(root)

    def write(name):
        facts = [publish.write_table(stores_frame(spark, name, "x"), root, name, "lojas")]
        return publish.commit_version(root, name, facts)

    with ThreadPoolExecutor(6) as writers:
        assert sorted(writers.map(write, "abcdef")) == [1, 2, 3, 4, 5, 6]
    log = publish.versions(spark, root).collect()
    assert [r["number"] for r in log] == [6, 5, 4, 3, 2, 1] and {r["version"] for r in log} == set("abcdef")
    assert publish.current_version(root) == log[0]["version"] and all(r["tables"][0]["rows"] == 2 for r in log)
    with pytest.raises(ConflictError, match="version 6 was committed"):
        publish.commit_version(root, "stale", [], base=5)
    assert publish.commit_version(root, "next", [], base=6) == 7
    assert [p.name for p in sorted((tmp_path / "out" / "versions").iterdir())] == [f"{k:012d}.json" for k in range(1, 8)]


def test_a_taken_number_is_never_written_over(tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert stores.create_new(path, b"first") and not stores.create_new(path, b"second")
    assert stores.read_all(path) == b"first" and len(list((tmp_path / "log").iterdir())) == 1


def test_published_facts_equal_a_recount(spark, tmp_path):
    out = str(tmp_path / "out")
    done = run_batch(spark, write_zip(tmp_path / "a.zip"), out, str(tmp_path / "q"))
    for name, facts in publish.facts_of(spark, out, done.version).items():
        table = publish.read_table(spark, out, name)
        assert publish.fingerprint(table) == {k: facts[k] for k in ("rows", "total", "mixed")}


def test_sweeps_take_superseded_versions_only(spark, tmp_path):
    root = str(tmp_path / "out")
    frame = stores_frame(spark, "L1")
    for name in "abcd":
        publish.commit_version(root, name, [publish.write_table(frame, root, name, "lojas")])
    publish.write_table(frame, root, "open", "lojas")
    with retention.pinned(root, "a"):
        states = {r["version"]: r["state"] for r in retention.sweep(spark, root, keep=1).collect()}
        assert states == {"a": "pinned", "b": "superseded", "c": "superseded", "d": "kept", "open": "unfinished"}
        assert publish.read_table(spark, root, "lojas", "a").count() == publish.read_table(spark, root, "lojas").count() == 1
    there = lambda: {p.name for p in (tmp_path / "out").glob("version=*")}
    assert there() == {"version=a", "version=d", "version=open"}
    retention.sweep(spark, root, keep=1, grace_seconds=-1)
    assert there() == {"version=d"} and publish.current_version(root) == "d"
    with pytest.raises(FileNotFoundError, match="gone"), retention.pinned(root, "a"):
        pass
    assert not list((tmp_path / "out" / "pins").iterdir())
    assert publish.commit_version(root, "e", []) == 5
    with pytest.raises(ValueError, match="always stays"):
        retention.marked(spark, root, keep=0)


def test_a_run_leaves_no_staged_tables(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    done = run_batch(spark, write_zip(tmp_path / "a.zip"), str(tmp_path / "out"), str(tmp_path / "q"))
    assert set(os.listdir(shared)) == before and done.summary.collect()[0]["validos"] == 3


def test_skip_index_reads_few_files_and_loses_no_match(spark, tmp_path):
    rng = random.Random(3)
    names = ["Ana", "Bruno", "CARLA", "Élio", "Zoë", "İnci"]
    rows = []
    for part in range(12):
        rows += [(f"S{part}-{k}", rng.choice(names), "Centro" if part % 4 else "Norte", f"Modelo {part}", None if k % 5 else "toyota", f"f{part}.csv", part) for k in range(30)]
    root = str(tmp_path / "fact")
    spark.createDataFrame(rows, "venda_id string, consultor string, loja string, modelo string, marca string, __source_file string, part int").repartition(12, "part").write.parquet(root)
    fact = spark.read.parquet(root)
    index = search_index.index_of(fact).cache()
    view = explore.explored(fact.selectExpr("*", *[f"cast(null as string) as {c}" for c in ("canal_origem", "forma_pagamento")]))
    files = fact.select("_metadata.file_path").distinct().count()
    for query in (*names, "norte", "modelo 11", "S7-2", "toyota", "f3.csv", " ana ", "nothing like it", "élio"):
        holding = {r[0] for r in explore.search(view, query).select("__source_file").distinct().collect()}
        kept = {r["file"] for r in search_index.files_to_read(index, query).collect()}
        read = {r[0] for r in fact.where(F.col("_metadata.file_path").isin(list(kept))).select("__source_file").distinct().collect()}
        assert holding <= read
    assert search_index.files_to_read(index, "nothing like it").count() == 0
    assert 0 < search_index.files_to_read(index, "modelo 11").count() <= files / 3
    assert search_index.files_to_read(index, "an") is None


def test_small_ranges_share_tasks(spark, tmp_path):
    """The number of tasks follows the bytes, not the ranges."""
    files = spark.createDataFrame([(f"{tmp_path}/a.csv", 64 << 20), (f"{tmp_path}/b.csv", 100)], "path string, length bigint")
    found = ranges.byte_ranges(files, 1 << 14)
    assert found.count() == 4097
    least = ranges.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert ranges.scan_ranges(found).rdd.getNumPartitions() <= max(least, 12)
    assert ranges.scan_ranges(ranges.byte_ranges(files)).rdd.getNumPartitions() == 3


def test_files_that_are_moved_lie_on_disk_once(spark, tmp_path):
    written = tmp_path / "written"
    written.mkdir()
    for k in range(3):
        (written / f"part-{k}.csv").write_bytes(b"a;b\n" * (k + 1))
    files = spark.createDataFrame([(f"x/_file {k}.csv", f"file:{written}/part-{k}.csv") for k in range(3)], "name string, path string")
    for _ in range(2):  # a task may run twice
        landed = raw_files.land_moves(files, f"{tmp_path}/landed").collect()
        assert sorted((r["name"], r["length"]) for r in landed) == [(f"x/_file {k}.csv", 4 * (k + 1)) for k in range(3)]
    assert not list(written.glob("*.csv")) and (tmp_path / "landed/x/_file 2.csv").read_bytes() == b"a;b\n" * 3


def test_archives_are_unpacked_block_by_block(spark, tmp_path, monkeypatch):
    """Members become files under names of our own, in blocks; damage and limits give a problem."""
    monkeypatch.setattr(archives, "BLOCK", 1000)
    content = b"venda_id;x\n" + b"S1;2\n" * 5000
    for name in ("good.zip", "bad.zip"):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_STORED) as archive:
            archive.writestr(f"{fv.SALES_FOLDER}/vendas_2025.csv", content)
            archive.writestr("../../escape.csv", b"y")
    data = bytearray((tmp_path / "bad.zip").read_bytes())
    data[3000] ^= 1
    (tmp_path / "bad.zip").write_bytes(data)
    (tmp_path / "none.zip").write_bytes(b"no archive")
    paths = spark.createDataFrame([(f"{tmp_path}/{n}.zip",) for n in ("good", "bad", "none")], "path string")
    found = {(r["archive"].rsplit("/", 1)[-1], r["source_file"]): r for r in archives.unpack(paths, f"{tmp_path}/out", listing.UNLIMITED).collect()}
    good = found["good.zip", f"{fv.SALES_FOLDER}/vendas_2025.csv"]
    assert good["problem"] is None and good["length"] == len(content) and good["schema_hint"] == "vendas" and open(good["path"], "rb").read() == content
    assert "damaged member" in found["bad.zip", f"{fv.SALES_FOLDER}/vendas_2025.csv"]["problem"] and "damaged archive" in found["none.zip", ""]["problem"]
    assert found["good.zip", "../../escape.csv"]["path"].startswith(f"{tmp_path}/out/") and not (tmp_path.parent / "escape.csv").exists()
    small = archives.unpack(paths.limit(1), f"{tmp_path}/out", listing.Limits(file_bytes=2000)).collect()
    assert [r["problem"] for r in small if r["schema_hint"]] == ["expanded content over the size limit"]
