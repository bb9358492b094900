from __future__ import annotations

import io
import sys
import zipfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from gondola.schema import raw_columns  # noqa: E402
from gondola.session import builder, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    local = {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
    }
    session = builder("tests").master("local[8]").config(map=local).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Frames of a raw table from dicts; columns not given are null."""

    def make(table: str, *rows: dict, **extra: str):
        columns = list(raw_columns(table)) + list(extra)
        data = [tuple((extra | row).get(c) for c in columns) for row in rows]
        kinds = [f"{c} {'date' if c == 'fecha_vigencia' else 'string'}" for c in columns]
        return spark.createDataFrame(data, ", ".join(kinds))

    return make


def product(**values: str) -> dict:
    base = {
        "id_comercio": "1",
        "id_bandera": "1",
        "id_sucursal": "10",
        "id_producto": "100",
        "productos_ean": "1",
        "productos_descripcion": "Leche 1L",
        "productos_precio_lista": "1500.50",
    }
    return base | values


def store(**values: str) -> dict:
    base = {
        "id_comercio": "1",
        "id_bandera": "1",
        "id_sucursal": "10",
        "sucursales_nombre": "Centro",
        "sucursales_tipo": "Supermercado",
        "sucursales_localidad": "Rosario",
        "sucursales_provincia": "AR-S",
    }
    return base | values


def merchant(**values: str) -> dict:
    return {"id_comercio": "1", "id_bandera": "1", "comercio_bandera_nombre": "Uno"} | values


def csv_text(table: str, rows: list[dict], columns: list[str] | None = None, footer: str | None = None) -> str:
    columns = columns or list(raw_columns(table))
    lines = ["|".join(columns)] + ["|".join(r.get(c) or "" for c in columns) for r in rows]
    return "\n".join(lines + ([f"Ultima actualizacion: {footer}"] if footer else [])) + "\n"


def child_zip(day: str | None, products: list[dict], id_comercio: str = "1", leave_out: str | None = None) -> bytes:
    files = {
        "comercio": csv_text("comercio", [merchant(id_comercio=id_comercio)], footer=day),
        "sucursales": csv_text("sucursales", [store(id_comercio=id_comercio)]),
        "productos": csv_text("productos", [p | {"id_comercio": id_comercio} for p in products]),
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for table, text in files.items():
            if table != leave_out:
                z.writestr(f"{table}.csv", text)
    return buffer.getvalue()


def master_zip(path: Path, children: list[bytes], folder: str = "dia") -> str:
    with zipfile.ZipFile(path, "w") as z:
        for i, content in enumerate(children):
            z.writestr(f"{folder}/child_{i}.zip", content)
    return str(path)
