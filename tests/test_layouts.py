"""Hand-written source files of the four layouts, with hand-derived results."""

import pytest
from conftest import rows

from scrutin.plans import elections as E
from scrutin.schemas import FLAT
from scrutin.sources import lines as L
from scrutin.sources.registry import selected_years

FLAT_NAMES = [f.name for f in FLAT.fields]


def save(folder, name, text, encoding="latin-1"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def line_2008(dep, com, bureau, turnout, *blocks, end=""):
    ins, abst, vot, bln, exp = turnout
    prefix = ["", dep, "DEP", com, "Ambérieu", bureau, ins, abst, "", vot, "", bln, "", "", exp, "", ""]
    return ";".join([*map(str, prefix), *[f for b in blocks for f in b]]) + end


def block_2008(nuance, nom, liste, voix):
    return [nuance, "M", nom, "Jean", liste, "0", str(voix), "1,0", "2,0"]


def file_2008(*round1, round2=()):
    return "\n".join(["preamble", " Tour1 ", "header", *round1, "Tour2", "header", *round2]) + "\n"


A, B = block_2008("ldvd", "DUPONT", "Ensemble", 30), block_2008("", "MARTIN", "Agir", 25)


def test_2008_units_blocks_and_filters(spark, folder):
    text = file_2008(
        line_2008("1", "4", "1", (100, 40, 60, 5, 55), A, B, end=";"),
        line_2008("1", "4", "2", (50, 10, 40, 2, 38), A, ["cut", "M"]),
        line_2008("1", "4", "2", (50, 10, 40, 2, 38), block_2008("X", "", "", " ")),
        "short;line",
        line_2008("ZA", "1", "1", (10, 0, 10, 0, 10), A),
        line_2008("971", "1", "1", (10, 0, 10, 0, 10), A),
        line_2008("2A", "4", "1", (10, 0, 10, 0, 40), block_2008("L", "B", "C", 5)),
        line_2008("56", "056AR01", "1", (50, 0, 50, 0, 50), A),
        line_2008("92", "019", "1", (9999, 1, 60, 0, 60), A),
        round2=[line_2008("1", "4", "1", (100, 50, 50, 0, 50), A)],
    )
    path = save(folder, "MN08_BVot_T1T2.txt", text)
    got = rows(E.load_year(spark, 2008, [path]))
    lib = ("DEP",)
    assert got == sorted(
        [
            (2008, 1, "01", *lib, "01004", "Ambérieu", 150, 50, 100, 7, 93, "LDVD", "DUPONT", "Jean", "Ensemble", 60),
            (2008, 1, "01", *lib, "01004", "Ambérieu", 150, 50, 100, 7, 93, "NC", "MARTIN", "Jean", "Agir", 25),
            (2008, 1, "92", *lib, "92019", "Ambérieu", 60, 0, 60, 0, 60, "LDVD", "DUPONT", "Jean", "Ensemble", 30),
            (2008, 2, "01", *lib, "01004", "Ambérieu", 100, 50, 50, 0, 50, "LDVD", "DUPONT", "Jean", "Ensemble", 30),
        ],
        key=repr,
    )


@pytest.mark.parametrize("text", ["Tour1\nh\n", "Tour2\nh\nTour1\nh\n", "nothing\n"])
def test_2008_markers_missing_or_reversed(spark, folder, text):
    with pytest.raises(ValueError):
        E.ballots_2008(spark, save(folder, "f.txt", text))


def test_sections_do_not_depend_on_block_size(spark, folder):
    data = [f"{'a' if i % 2 else 'é'};{i};" + "x" * (i % 50) for i in range(400)]
    text = "\n".join(["pre", "Tour1", "head", *data[:150], "Tour2", "head", *data[150:], "Tour1", ""])
    path = save(folder, "f.txt", text)
    expected = [(d, 1) for d in data[:150]] + [(d, 2) for d in data[150:]] + [("Tour1", 2)]
    for size in (64, 200, 1024, None):
        lines = L.read_lines(spark, path, "latin-1", size)
        got = rows(L.sectioned(lines, ["Tour1", "Tour2"]).select("line", "section"))
        assert got == sorted(expected, key=repr), size


def test_header_is_dropped_once_per_file(spark, folder):
    for name in ("a", "b"):
        save(folder, name, "\n".join(["head"] + [f"{name}{i}" for i in range(100)]))
    lines = L.without_header(L.read_lines(spark, folder, "latin-1", 32))
    assert rows(lines.select("line")) == sorted(
        [(f"{n}{i}",) for n in "ab" for i in range(100)], key=repr
    )


def test_2014_maximum_per_station_and_null_department_label(spark, folder):
    text = "\n".join(
        [
            "-- comment",
            "1;01;004;Ambérieu;0001;100;60;55;1;DUPONT;Jean;LDVD;30;extra",
            "1;01;004;Ambérieu;0001;110;60;55;2;MARTIN;;;25",
            "1;01;004;Ambérieu;0001;110;60;55;2;SHORT;Anne;LSOC",
            "1;01;005;Nulle;0001;abc;60;55;2;X;Y;Z;5",
            "",
        ]
    )
    got = rows(E.load_year(spark, 2014, [save(folder, "MN14_Bvot_T1T2.txt", text)]))
    turnout = (110, 50, 60, 5, 55)
    assert got == sorted(
        [
            (2014, 1, "01", None, "01004", "Ambérieu", *turnout, "LDVD", "DUPONT", "Jean", "1", 30),
            (2014, 1, "01", None, "01004", "Ambérieu", *turnout, "NC", "MARTIN", "", "2", 25),
        ],
        key=repr,
    )


def test_2014_without_usable_line_is_empty(spark, folder):
    got = E.load_year(spark, 2014, [save(folder, "MN14_Bvot_T1T2.txt", "-- only\n")])
    assert got.columns == FLAT_NAMES and got.count() == 0


def line_2020(sep, com, blocks, blancs="2"):
    prefix = ["01", "AIN", com, "Amb", "1", "100", "40", "", "60", "", blancs, "", "", "3", "", "", "55", "", ""]
    return sep.join([*prefix, *[f for b in blocks for f in b]])


def block_2020(nuance, nom, voix, tail=("1,0", "2,0")):
    return ["1", nuance, "M", nom, "Jean", "Liste", str(voix), *tail]


def test_2020_two_files_and_trailing_fields(spark, folder):
    t1 = "\n".join(
        [
            "head",
            line_2020("\t", "4", [block_2020("", "DUPONT", 30), [""] * 9]) + "\t\t\t",
            # the last block loses its empty fields and with them its completeness
            line_2020("\t", "5", [block_2020("LSOC", "MARTIN", 20), block_2020("L", "CUT", 10, ("", ""))]),
            line_2020("\t", "6", [block_2020("LSOC", "NOBLANK", 20)], blancs=""),
        ]
    )
    t2 = "\n".join(["head", line_2020(";", "4", [block_2020("LDVD", "DUPONT", 40)])])
    names = E.source_of(2020).files
    paths = [save(folder, names[0], t1), save(folder, names[1], t2)]
    got = {(r.tour, r.code_commune, r.nom): r for r in E.load_year(spark, 2020, paths).collect()}
    assert set(got) == {
        (1, "01004", "DUPONT"), (1, "01005", "MARTIN"), (1, "01006", "NOBLANK"), (2, "01004", "DUPONT"),
    }
    first = got[(1, "01004", "DUPONT")]
    assert (first.code_nuance, first.blancs_nuls, first.voix) == ("NC", 5, 30)
    # a null sum of blanks is a maximum of nothing per station, which totals 0 per commune
    assert got[(1, "01006", "NOBLANK")].blancs_nuls == 0


def line_2026(com, label, blocks, fields=None):
    prefix = ["1", "AIN", com, label, "1", "100", "60", "", "40", "", "55", "", "", "2", "", "", "3", "", ""]
    cells = [*prefix, *[f for b in blocks for f in b]]
    return ";".join(cells[:fields])


def block_2026(nom, nuance, abbr, full, voix):
    return ["1", nom, "Jean", "M", nuance, abbr, full, str(voix), "", "", "", "", ""]


@pytest.mark.parametrize("breaks", [False, True])
def test_2026_quotes_slots_and_short_rows(spark, folder, breaks):
    head = ";".join(f"h{i}" for i in range(19 + 2 * 13))
    one = block_2026(' "A;""B""" '.strip(), "ldvd", "ABR", " ", 30)
    two = block_2026("MARTIN", "", "", "Full", 25)
    label = '"Amb\nérieu"' if breaks else "Ambérieu"
    t1 = "\n".join(
        [
            head,
            line_2026("1004", label, [one, two]),
            line_2026("01005", label, [one, two], fields=19 + 13 + 12),
            line_2026("01006", label, [one], fields=10),
            line_2026("01007", label, [[""] * 13, two, two]),
        ]
    )
    names = E.source_of(2026).files
    paths = [save(folder, n, t, "utf-8") for n, t in zip(names, (t1, head + "\n"))]
    ballots = E.ballots_2026(spark, paths)
    got = rows(E.finalize(ballots).select("code_commune", "libelle_commune", "code_nuance", "nom", "liste", "voix"))
    name = label.strip('"')
    assert got == sorted(
        [
            ("01004", name, "LDVD", 'A;"B"', "ABR", 30),
            ("01004", name, "NC", "MARTIN", "Full", 25),
            ("01005", name, "LDVD", 'A;"B"', "ABR", 30),
            ("01007", name, "NC", "MARTIN", "Full", 25),
        ],
        key=repr,
    )


def test_folder_build_skips_or_fails_and_keeps_common_communes(spark, folder):
    save(
        folder, "MN08_BVot_T1T2.txt",
        file_2008(
            line_2008("1", "4", "1", (100, 40, 60, 5, 55), A),
            line_2008("1", "5", "1", (100, 40, 60, 5, 55), A),
        ),
    )
    save(folder, "MN14_Bvot_T1T2.txt", "1;01;004;Amb;0001;100;60;55;1;DUPONT;Jean;LDVD;30\n")
    save(folder, E.source_of(2020).files[0], "only one of two files")
    built = E.build_flat(spark, folder)
    assert (built.years, built.skipped, built.empty_years()) == ([2008, 2014], [2020, 2026], [])
    assert {(r.annee_election, r.code_commune) for r in built.table.collect()} == {
        (2008, "01004"), (2014, "01004"),
    }
    # finalizing the stack again changes nothing
    assert rows(E.finalize(built.table)) == rows(built.table)
    with pytest.raises(FileNotFoundError):
        E.build_flat(spark, folder, strict=True)
    single = E.build_flat(spark, f"{folder}/MN08_BVot_T1T2.txt", "2008")
    assert single.table.select("code_commune").distinct().count() == 2
    with pytest.raises(ValueError):
        E.build_flat(spark, f"{folder}/MN08_BVot_T1T2.txt", "2014")


def test_default_folder(spark, folder, monkeypatch):
    monkeypatch.setattr(E, "locate", lambda spark, source, path: [f"{path}/{f}" for f in source.files])
    monkeypatch.setattr(E, "READERS", {2008: lambda spark, paths, encoding, year: (_ for _ in ()).throw(LookupError(paths[0]))})
    with pytest.raises(LookupError, match="raw_data/MN08_BVot_T1T2.txt"):
        E.load_year(spark, 2008)


def test_year_selection():
    assert selected_years(" ALL ") == [2008, 2014, 2020, 2026]
    assert selected_years("2020, 2008,2020") == [2020, 2008]
    for bad in ("", "x", "1999", ","):
        with pytest.raises(ValueError):
            selected_years(bad)


def ballots_of(spark, folder, texts, **options):
    """Candidates of files in one folder per round."""
    import os

    paths = []
    for number in (1, 2):
        path = f"{folder}/round{number}"
        os.mkdir(path)
        for name, text in (texts if number == 1 else {"empty.csv": ";".join(["h"] * 32) + "\n"}).items():
            save(path, name, text, "utf-8")
        paths.append(path)
    return E.ballots_2026(spark, paths, **options)


def file_2026(slots, *lines):
    return "\n".join([";".join(["h"] * (19 + slots * 13)), *lines]) + "\n"


def test_2026_stray_quotes_and_headers_of_their_own(spark, folder):
    one, two, three = (block_2026(n, "X", "A", "L", 5) for n in ('D"A', 'B"X', "C"))
    texts = {
        "a.csv": file_2026(1, line_2026("1004", "Amb", [one, two])),
        "b.csv": file_2026(2, line_2026("1005", "Amb", [one, two, three])),
    }
    got = ballots_of(spark, folder, texts).select("code_commune", "nom")
    assert rows(got) == [("01004", 'D"A'), ("01005", 'B"X'), ("01005", 'D"A')]


def test_2026_line_breaks_in_quotes_need_no_flag(spark, folder):
    texts = {"a.csv": file_2026(1, line_2026("1004", '"Amb\n00100;x"', [block_2026("DUPONT", "X", "A", "L", 5)]))}
    names = E.source_of(2026).files
    for name in names:
        save(folder, name, texts["a.csv"], "utf-8")
    built = E.build_flat(spark, folder, "2026")
    assert rows(built.table.select("tour", "code_commune", "libelle_commune")) == [
        (1, "01004", "Amb\n00100;x"), (2, "01004", "Amb\n00100;x")
    ]


def test_fields_are_counted_as_they_are_parsed(spark):
    lines = ['1;a"b;c"d;x', '"a;b";c', '"a""b;c";d;"e', 'x;"";y', '"a"b;c', "a"]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    got = frame.select(L.field_count(frame.line, ";").alias("n"), L.is_cut(frame.line, ";").alias("cut")).collect()
    assert [r.n for r in got] == [4, 2, 3, 3, 2, 1]
    assert [r.cut for r in got] == [False, False, True, False, False, False]


def test_lines_keep_the_settings_of_the_caller(spark, folder):
    path = save(folder, "f.txt", "\n".join(f"line {i}" for i in range(200)))
    settings = {"spark.sql.shuffle.partitions": "17", "spark.sql.files.maxPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = L.read_lines(spark, path, "latin-1", 64)
        assert lines.sparkSession.conf.get("spark.sql.shuffle.partitions") == "17"
        assert lines.sparkSession.conf.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")
        heads = lines.filter("row = 0").select("block").distinct().count()
        assert heads == lines.select("block").distinct().count() > 10
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
