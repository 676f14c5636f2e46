"""A small generated library of run folders, a register and a catalogue."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

# Tags, names and texts of the method and identity files.
WAVELENGTHS = ("254", "256", "300")
PUMP = "Binary Pump"


def _row(values: dict) -> str:
    cells = "".join(
        f"<Parameter><Name>{n}</Name><ID>x</ID><Unit />" + (f"<Value>{v}</Value>" if v != "" else "<Value />") + "</Parameter>"
        for n, v in values.items()
    )
    return f"<Row>{cells}</Row>"


def method_xml(steps, percents=(("A", 95.0), ("B", 5.0)), section=PUMP, bom=True) -> bytes:
    """``steps``: (time, a, b) of the timetable."""
    composition = "".join(
        _row({"Channel": c, "Ch. 1 Solv.": f"solvent {c}", "Name 1": "", "Ch2 Solv.": "water", "Name 2": "",
              "Selected": "Ch. 1", "Used": "Yes", "Percent": p})
        for c, p in percents
    )
    timetable = "".join(
        _row({"Time": t, "A": a, "B": b, "Flow": "1.000", "Pressure": "6999.96"}) for t, a, b in steps
    )
    body = (
        '<?xml version="1.0" encoding="utf-8"?>\n<ACAML xmlns="urn:example:acaml" '
        'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"><Doc><Content><MethodConfiguration>'
        "<MethodDescription><Section><Name>All</Name><Section><Name>Sampler</Name><Table><Name>Timetable</Name>"
        f"</Table></Section><Section><Name>{section}</Name><Section><Name>Stroke A</Name></Section>"
        f"<Table><Name>Solvent Composition</Name>{composition}</Table>"
        f"<Table><Name>Timetable</Name>{timetable}</Table></Section></Section></MethodDescription>"
        "</MethodConfiguration></Content></Doc></ACAML>"
    )
    return (b"\xef\xbb\xbf" if bom else b"") + body.encode()


def identity_xml(run_id: str) -> bytes:
    return (
        '\ufeff<?xml version="1.0" encoding="utf-8"?><ACAML xmlns="urn:example:acaml"><Doc><Content><SampleContexts>'
        f'<Setup id="{run_id}" ver="0"><IdentParam_ID id="other" /></Setup></SampleContexts></Content></Doc></ACAML>'
    ).encode()


def image(run_id: str, rows: int, step: float, peak: int) -> pa.Table:
    mins = [0.0 if i == 0 else i * step + (1e-5 if i % 2 else -1e-5) for i in range(rows)]
    signal = [float(-abs(i - peak)) for i in range(rows)]
    columns = {"id": [run_id] * rows, "mins": mins}
    for n, nm in enumerate(WAVELENGTHS):
        columns[nm] = [v * (n + 1) for v in signal]
    return pa.table(columns)


STANDARD = ((38, 0, 100), (40, 0, 100), (42, 95, 5), (52, 95, 5))
STEEP = ((30, 0, 100), (32, 0, 100), (34, 95, 5), (44, 95, 5))

# folder, notebook, date, id file, timetable, rows, step in minutes
RUNS = [
    ("013 a+b%20é.D", "13", "04-Apr-23, 10:00:00", "sequence.acam_", STANDARD, 60, 0.4 / 60),
    ("054.D", "54", "05-Apr-23, 10:00:00", "sample.acaml", STANDARD, 61, 0.4 / 60),
    ("061.D", "61", "6-Apr-23, 10:00:00", "sequence.acam_", STANDARD, 60, 0.4 / 60),
    ("089.D", "89", "07-Apr-23, 10:00:00", "sequence.acam_", STANDARD, 60, 0.4 / 60),
    ("096.D", "96", "08-Apr-23, 10:00:00", "sequence.acam_", STEEP, 60, 0.4 / 60),
    ("117.D", "unregistered", "09-Apr-23, 10:00:00", "sequence.acam_", STANDARD, 60, 0.4 / 60),
]


def build_library(root: Path) -> dict[str, str]:
    lib = root / "lib"
    for folder, notebook, date, id_file, steps, rows, step in RUNS:
        run_dir = lib / folder
        extract = run_dir / "extract_2024-01-01T000000"
        extract.mkdir(parents=True)
        run_id = f"guid-{notebook}"
        (run_dir / "acq.macaml").write_bytes(method_xml(steps))
        (run_dir / id_file).write_bytes(identity_xml(run_id))
        metadata = {
            "notebook": notebook, "date": date, "method": " Gradient ", "injection_volume": "10.0",
            "seq_name": "Wines_2023-04-04_12-01-53", "seq_desc": "April", "vialnum": "Vial 1",
            "originalfilepath": "C:\\Data", "id": run_id, "desc": "x",
        }
        pq.write_table(pa.table({k: [v] for k, v in metadata.items()}), extract / "metadata.parquet")
        pq.write_table(image(run_id, rows, step, peak=20), extract / "data.parquet")
    catalogue = {
        name: [f"{name} {i}" for i in range(4)]
        for name in ("Size", "Locale", "Country", "Region", "SubRegion", "Appellation", "Producer", "Type", "Color", "Category")
    }
    catalogue["Vintage"] = ["2018", "2019", "2020", "1001"]
    catalogue["Wine"] = ["' Ch\u00e2teau \"One\"", "Two &amp; Sons", " THREE ", "four"]
    catalogue["Varietal"] = ["Shiraz", "Merlot", "Malbec", "Blend"]
    catalogue["iWine"] = ["1", "2", "3", "4"]  # further columns are ignored
    pq.write_table(pa.table(catalogue), root / "catalogue.parquet")
    register = [
        ("raw", "13", "chateau one", 2018, "y"), ("raw", "54", "two & sons", 2019, "n"),
        ("raw", "61", "three", 2020, None), ("raw", "89", "Four", 1001, "y"),
        ("raw", "96", "four", 1001, "y"), ("cuprac", "c1", "four", 1001, "y"),
        ("raw", "none", "not there", 2018, "y"), ("raw", "null", None, 2018, "y"),
    ]
    frame = {
        "detection": [r[0] for r in register], "sampler": ["JV"] * 8, "samplecode": [r[1] for r in register],
        "vintage": pa.array([r[3] for r in register], pa.int32()), "wine": [r[2] for r in register],
        "open_date": ["1/2/2023"] * 8, "sampled_date": pa.nulls(8, pa.string()),
        "added_to_cellartracker": [r[4] for r in register], "notes": ["it's"] * 8,
        "size": pa.array([0.75] * 8, pa.float32()),
    }
    pq.write_table(pa.table(frame), root / "register.parquet")
    return {
        "data_dir": str(lib),
        "register_path": str(root / "register.parquet"),
        "catalogue_path": str(root / "catalogue.parquet"),
    }
