"""Column contracts of the raw files and of the silver tables.

Raw files are read as text only. Silver tables have fixed names and types;
columns are matched by name, missing ones become typed nulls and columns
outside the contract are dropped.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw file columns, in file order.
RAW_COLUMNS = {
    "comercio": (
        "id_comercio",
        "id_bandera",
        "comercio_cuit",
        "comercio_razon_social",
        "comercio_bandera_nombre",
        "comercio_bandera_url",
        "comercio_ultima_actualizacion",
        "comercio_version_sepa",
    ),
    "sucursales": (
        "id_comercio",
        "id_bandera",
        "id_sucursal",
        "sucursales_nombre",
        "sucursales_tipo",
        "sucursales_calle",
        "sucursales_numero",
        "sucursales_latitud",
        "sucursales_longitud",
        "sucursales_observaciones",
        "sucursales_barrio",
        "sucursales_codigo_postal",
        "sucursales_localidad",
        "sucursales_provincia",
        "sucursales_lunes_horario_atencion",
        "sucursales_martes_horario_atencion",
        "sucursales_miercoles_horario_atencion",
        "sucursales_jueves_horario_atencion",
        "sucursales_viernes_horario_atencion",
        "sucursales_sabado_horario_atencion",
        "sucursales_domingo_horario_atencion",
    ),
    "productos": (
        "id_comercio",
        "id_bandera",
        "id_sucursal",
        "id_producto",
        "productos_ean",
        "productos_descripcion",
        "productos_cantidad_presentacion",
        "productos_unidad_medida_presentacion",
        "productos_marca",
        "productos_precio_lista",
        "productos_precio_referencia",
        "productos_cantidad_referencia",
        "productos_unidad_medida_referencia",
        "productos_precio_unitario_promo1",
        "productos_leyenda_promo1",
        "productos_precio_unitario_promo2",
        "productos_leyenda_promo2",
    ),
}

RAW_TABLES = tuple(RAW_COLUMNS)

DATE = "fecha_vigencia"

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# Names, types and order of the silver tables.
SILVER = {
    "precios": _struct(
        id_comercio=_S,
        id_bandera=_S,
        id_sucursal=_S,
        id_producto=_S,
        ean=_B,
        descripcion=_S,
        marca=_S,
        cantidad_presentacion=_D,
        unidad_medida_presentacion=_S,
        precio_lista=_D,
        precio_referencia=_D,
        cantidad_referencia=_D,
        unidad_medida_referencia=_S,
        precio_promo1=_D,
        leyenda_promo1=_S,
        precio_promo2=_D,
        leyenda_promo2=_S,
        fecha_vigencia=T.DateType(),
        scraped_at=T.TimestampNTZType(),
    ),
    "dim_sucursales": _struct(
        id_comercio=_S,
        id_bandera=_S,
        id_sucursal=_S,
        nombre=_S,
        tipo=_S,
        calle=_S,
        numero=_S,
        latitud=_D,
        longitud=_D,
        codigo_postal=_S,
        localidad=_S,
        provincia=_S,
        barrio=_S,
        fecha_vigencia=T.DateType(),
    ),
    "dim_comercios": _struct(
        id_comercio=_S,
        id_bandera=_S,
        cuit=_S,
        razon_social=_S,
        bandera_nombre=_S,
        bandera_url=_S,
        fecha_vigencia=T.DateType(),
    ),
    "dim_productos": _struct(
        id_producto=_S,
        ean=_B,
        descripcion=_S,
        marca=_S,
        cantidad_presentacion=_D,
        unidad_medida_presentacion=_S,
        fecha_vigencia=T.DateType(),
    ),
}

# Raw name -> silver name. Raw columns without an entry keep
# their name when it is an id and are dropped otherwise.
_PRODUCT_NAMES = {
    "productos_ean": "ean",
    "productos_descripcion": "descripcion",
    "productos_marca": "marca",
    "productos_cantidad_presentacion": "cantidad_presentacion",
    "productos_unidad_medida_presentacion": "unidad_medida_presentacion",
    "productos_precio_lista": "precio_lista",
    "productos_precio_referencia": "precio_referencia",
    "productos_cantidad_referencia": "cantidad_referencia",
    "productos_unidad_medida_referencia": "unidad_medida_referencia",
    "productos_precio_unitario_promo1": "precio_promo1",
    "productos_leyenda_promo1": "leyenda_promo1",
    "productos_precio_unitario_promo2": "precio_promo2",
    "productos_leyenda_promo2": "leyenda_promo2",
}
SILVER_NAMES = {
    "precios": _PRODUCT_NAMES,
    "dim_productos": _PRODUCT_NAMES,
    "dim_sucursales": {
        "sucursales_nombre": "nombre",
        "sucursales_tipo": "tipo",
        "sucursales_calle": "calle",
        "sucursales_numero": "numero",
        "sucursales_latitud": "latitud",
        "sucursales_longitud": "longitud",
        "sucursales_codigo_postal": "codigo_postal",
        "sucursales_localidad": "localidad",
        "sucursales_provincia": "provincia",
        "sucursales_barrio": "barrio",
    },
    "dim_comercios": {
        "comercio_cuit": "cuit",
        "comercio_razon_social": "razon_social",
        "comercio_bandera_nombre": "bandera_nombre",
        "comercio_bandera_url": "bandera_url",
    },
}

MERCHANT_KEYS = ("id_comercio", "id_bandera")
STORE_KEYS = ("id_comercio", "id_bandera", "id_sucursal")
# Grain of the deduplicated price fact and of the current dimensions. The key
# lists are parameters of every operator that uses them: stores are only unique
# within (comercio, bandera), so a caller may add id_bandera.
QUOTE_KEYS = ("fecha_vigencia", "id_comercio", "id_sucursal", "id_producto")
STORE_CURRENT_KEYS = ("id_sucursal", "id_comercio")
PRODUCT_KEYS = ("id_producto",)

AUDIT_BRONZE = _struct(
    fecha_vigencia=T.DateType(),
    table_type=_S,
    csv_row_count=T.LongType(),
    csv_column_count=T.IntegerType(),
    parquet_row_count=T.LongType(),
    raw_zip_path=_S,
    parquet_path=_S,
    malformed_zips_count=T.LongType(),
    stale_count=T.LongType(),
    unknown_count=T.LongType(),
    ingested_at=T.TimestampNTZType(),
)
AUDIT_SILVER = _struct(
    fecha_vigencia=T.DateType(),
    table_type=_S,
    validation_dropped=T.LongType(),
    integrity_dropped=T.LongType(),
    negative_price_count=T.LongType(),
    silver_loaded=T.LongType(),
    ingested_at=T.TimestampNTZType(),
)


def raw_columns(table: str) -> tuple[str, ...]:
    if table not in RAW_COLUMNS:
        raise ValueError(f"unknown raw table {table!r}; known: {', '.join(RAW_COLUMNS)}")
    return RAW_COLUMNS[table]


def raw_schema(table: str) -> T.StructType:
    return _struct(**{name: _S for name in raw_columns(table)})


def silver_schema(table: str) -> T.StructType:
    if table not in SILVER:
        raise ValueError(f"unknown silver table {table!r}; known: {', '.join(SILVER)}")
    return SILVER[table]
