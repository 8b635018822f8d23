"""Table specifications: fields in file order, types, required values, limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    required: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    header: bool = True
    delimiter: str = ";"
    encoding: str = "UTF-8"
    key: str | None = None
    aliases: dict[str, str] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def limits(self) -> dict[str, int]:
        return {f.name: f.max_length for f in self.fields if f.max_length}

    def schema(self) -> T.StructType:
        """Typed schema; a type outside the four supported ones is read as text."""
        known = {
            "string": T.StringType(),
            "double": T.DoubleType(),
            "boolean": T.BooleanType(),
            "int": T.IntegerType(),
        }
        return T.StructType(
            [
                T.StructField(f.name, known.get(f.type, T.StringType()), not f.required)
                for f in self.fields
            ]
        )

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])


# The raw feeds' columns, in file order.
TRAFFIC = TableSpec(
    "traffic",
    (
        Field("datetime"),
        Field("predefinedLocationReference", required=True),
        Field("averageVehicleSpeed", "int", required=True),
        Field("travelTime", "int", required=True),
        Field("travelTimeReliability", "int", required=True),
        Field("trafficStatus", required=True),
    ),
    header=False,
)

WEIGHING = TableSpec(
    "weighing",
    (
        Field("Date_de_la_levee", required=True),
        Field("Heure_de_la_levee", required=True),
        Field("Code_puce"),
        Field("Pesee_net", "double"),
        Field("Statut_de_la_levee", "int", required=True),
        Field("Latitude", "double"),
        Field("Longitude", "double"),
        Field("Bouton_poussoir_1", "double"),
        Field("Bouton_poussoir_2", "double"),
        Field("Bouton_poussoir_3", "double"),
        Field("Bouton_poussoir_4", "double"),
        Field("Bouton_poussoir_5", "double"),
        Field("Bouton_poussoir_6", "double"),
        Field("Statut_du_bac"),
        Field("Immatriculation"),
        Field("Tournee"),
    ),
)

PRODUCER = TableSpec(
    "producer",
    (
        Field("code_producteur", "int", required=True),
        Field("rva_adr", "int"),
        Field("code_insee", "int"),
        Field("nom_commune", required=True, max_length=500),
        Field("type_producteur", max_length=100),
        Field("activite", required=True, max_length=500),
        Field("longitude", "double"),
        Field("latitude", "double"),
        Field("date_photo", required=True),
    ),
    key="code_producteur",
)

BIN = TableSpec(
    "bin",
    (
        Field("code_producteur", "int", required=True),
        Field("categorie_recipient", required=True, max_length=100),
        Field("type_recipient", required=True, max_length=500),
        Field("litrage_recipient", "int", required=True),
        Field("code_puce", required=True, max_length=10),
        Field("frequence_om", "int"),
        Field("frequence_cs", "double"),
        Field("date_photo", required=True),
    ),
    key="code_puce",
    aliases={"type_de_recipient": "type_recipient"},
)

OUTLET = TableSpec(
    "outlet",
    (
        Field("immat", required=True),
        Field("date_service_vehic"),
        Field("description_tournee"),
        Field("km_realise", "int", required=True),
        Field("no_bon"),
        Field("lot"),
        Field("service", "int", required=True),
        Field("nom_rech_lieu_de_vidage"),
        Field("multiples_lignes", "double"),
        Field("cle_unique_ligne_ticket"),
    ),
)


_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The stored tables.
PRODUCER_DIM = _struct(
    "id_producteur BIGINT, code_producteur INT, id_rva INT, commune STRING, code_insee INT, "
    "type_producteur STRING, activite STRING, latitude DOUBLE, longitude DOUBLE, "
    "date_debut TIMESTAMP, date_fin TIMESTAMP, date_crea TIMESTAMP, date_modif TIMESTAMP, "
    "year STRING, month STRING, day STRING"
)
BIN_DIM = _struct(
    "id_bac BIGINT, code_puce STRING, code_producteur INT, categorie_recipient STRING, "
    "type_recipient STRING, litrage_recipient INT, type_puce STRING, nb_collecte DOUBLE, "
    "date_debut TIMESTAMP, date_fin TIMESTAMP, date_crea TIMESTAMP, date_modif TIMESTAMP, "
    "year STRING, month STRING, day STRING, id_producteur BIGINT"
)
OUTLET_FACT = _struct(
    "code_immat STRING, date_mesure STRING, code_tournee STRING, distance DOUBLE, secteur STRING, "
    "nb_bac INT, localisation_vidage STRING, poids DOUBLE, type_vehicule STRING, "
    "date_crea TIMESTAMP, date_modif TIMESTAMP"
)
POINTER = _struct("date TIMESTAMP, path STRING")
MEASURE = _struct(
    "id STRING, deveui STRING, tramedate STRING, name STRING, value FLOAT, insertedDate STRING, "
    "year STRING, month STRING, day STRING"
)
