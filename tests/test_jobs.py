"""Registry, extracts and exports on small hand-written tables."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from adapter import clinic
from wardloom import Catalog, Params
from wardloom.operators.quality import QualityError
from wardloom.plans.contracts import CONTRACTS, require_contract
from wardloom.plans.exports import EXPORTS, eligible_patients, export_rows
from wardloom.plans.extracts import EXTRACTS, administration, demographics, microbiology, observations
from wardloom.plans.registry import check_registry, new_participants, register_participants
from wardloom.plans.views import VIEWS, movement, publish_views

PARAMS = Params(salt="s", provenance="Centre", as_of=datetime(2021, 12, 31))
COHORT = "UHL_System_Number string, dateadded date"


def table(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_registry_is_stable(spark):
    people = table(spark, "uhl_system_number string", ("K1",), ("K2 ",), ("k1",))
    empty = table(spark, "participant_identifier string, uhl_system_number string")
    first = register_participants(people, empty, PARAMS)
    check_registry(first)
    assert first.count() == 2
    assert all(r.participant_identifier.startswith("HCVPt") for r in first.collect())
    known = spark.createDataFrame(first.collect(), first.schema)
    assert new_participants(people, known, PARAMS).count() == 0
    more = register_participants(people.union(table(spark, "k string", ("K3",))), known, PARAMS)
    assert set(rows(known)) < set(rows(more)) and more.count() == 3
    with pytest.raises(ValueError, match="salt"):
        new_participants(people, known, replace(PARAMS, salt=None))


def test_registry_resolves_collisions(spark):
    schema = "participant_identifier string, uhl_system_number string"
    few = replace(PARAMS, id_digits=1)
    people = table(spark, "uhl_system_number string", *[(f"K{i}",) for i in range(40)])
    first = register_participants(people.filter("uhl_system_number < 'K2'"), table(spark, schema), few)
    check_registry(first)
    stored = spark.createDataFrame(first.collect(), schema)
    more = register_participants(people, stored, few)
    check_registry(more)
    assert more.count() == 40 and set(rows(stored)) < set(rows(more))


def test_registry_check_finds_a_collision(spark):
    twice = table(spark, "participant_identifier string, uhl_system_number string", ("P1", "K1"), ("P1", "K2"))
    with pytest.raises(QualityError, match="participant_identifier"):
        check_registry(twice)


def test_two_postcodes_fail_the_patient_key(spark, warehouse):
    patients = warehouse["PATIENT"]
    doubled = patients.union(patients.withColumn("Post_Code", F.lit("QX9 9ZZ")))
    catalog = warehouse.with_tables(PATIENT=doubled)
    from wardloom.plans.run import check_target

    people = demographics.build(catalog, clinic.PARAMS)
    with pytest.raises(QualityError, match="not unique"):
        check_target("demographics")(people)


def _observations(spark, keys):
    return Catalog(
        {
            "ObsExport": table(
                spark,
                "ObsId int, `System Number > Patient ID` string, Timestamp timestamp_ntz, Temp int,"
                " Temp_units string, Temp_ews int",
                (1, "a", datetime(2020, 1, 1), 37, "C", 0),
                (2, "A ", datetime(2019, 12, 31, 23, 59), 38, "C", 0),
                (3, "b", datetime(2020, 5, 1), 39, "C", 0),
                (4, "A", datetime(2020, 5, 1), None, "C", 0),
            ),
            "all_suspected_covid": table(spark, COHORT, *[(k, date(2020, 2, 1)) for k in keys]),
        }
    )


def test_observations(spark):
    got = observations.build(_observations(spark, ["A"]), PARAMS)
    assert rows(got.select("uhl_system_number", "observation_id", "observation_code", "observation_result")) == [
        ("a", 1, "Temp", "37")
    ]


@pytest.mark.parametrize("name", list(EXTRACTS))
def test_contract_and_empty_cohort(spark, warehouse, name):
    none = warehouse["all_suspected_covid"].limit(0)
    got = EXTRACTS[name](warehouse.with_tables(all_suspected_covid=none), clinic.PARAMS)
    require_contract(got, name)
    assert got.count() == 0


def test_contract_is_enforced(spark):
    good = table(spark, ", ".join(f"`{c}` {'string' if t == 'any' else t}" for c, t in CONTRACTS["orders"].items()))
    require_contract(good, "orders")
    with pytest.raises(QualityError, match="columns"):
        require_contract(good.drop("order_id"), "orders")
    with pytest.raises(QualityError, match="types"):
        require_contract(good.withColumn("order_date_time", F.lit(1)), "orders")


def test_class_without_name_and_repeated_dose(spark):
    catalog = Catalog(
        {
            "all_suspected_covid": table(spark, COHORT, ("p", date(2020, 2, 1))),
            "tciPerson": table(spark, "id int, externalId string", (1, "P")),
            "tciMedication": table(
                spark,
                "id int, personId int, udmProductID int, medicationName string, createdOn timestamp_ntz,"
                " prescribeMethodName string, WHO_PRESCRIBED_WARDSTAY_ID string",
                (10, 1, 100, "med", datetime(2020, 1, 5), "m", None),
                (11, 1, 101, "unclassed", datetime(2020, 1, 5), "m", None),
            ),
            "tciAdminEvent": table(
                spark,
                "id int, medicationid int, eventDateTime timestamp_ntz, doseId int, dose int, doseUnit string,"
                " roa int",
                (1, 10, datetime(2020, 2, 1), 1, 5, "mg", 1),
                (1, 10, datetime(2020, 2, 1), 2, 5, "mg", 1),
                (2, 10, datetime(2020, 1, 1), 1, 5, "mg", 1),
                (3, 11, datetime(2020, 2, 1), 1, 5, "mg", 1),
                # the same event twice falls into one group and counts its classes twice
                (4, 10, datetime(2020, 2, 1), 1, 5, "mg", 9),
                (4, 10, datetime(2020, 2, 1), 1, 5, "mg", 9),
            ),
            "udmProduct": table(spark, "ID int", (100,), (101,)),
            "udmDrugClassProduct": table(
                spark, "ProductID int, DrugClassBrandID int", (100, 1), (100, 2), (100, 3), (101, 9)
            ),
            "udmDrugClassBrand": table(
                spark, "ID int, DrugClassActiveIngredientSetID int", (1, 1), (2, 2), (3, 3)
            ),
            "udmDrugClassAIS": table(spark, "ID int, DrugClassID int", (1, 1), (2, 2), (3, 7)),
            "udmDrugClass": table(spark, "ID int, name string", (1, "zeta"), (2, None)),
            "MF_DOSAGE_ASSIST_ROUTE_OF_ADMINISTRATION_WHO": table(
                spark, "reference int, name string", (1, "oral")
            ),
        }
    )
    got = administration.build(catalog, PARAMS).select("prescription_order_id", "therapeutical_class", "route")
    assert rows(got) == [
        (1, " , zeta", "oral"),
        (1, " , zeta", "oral"),
        (4, " ,  , zeta, zeta", None),
    ]


def test_organisms_fan_out(spark):
    catalog = Catalog(
        {
            "all_suspected_covid": table(spark, COHORT, ("p", date(2020, 2, 1))),
            "REQUEST_PATIENT_DETAILS": table(
                spark, "Request_Patient_Details string, Hospital_Number string", ("r", "P")
            ),
            "ORDERS_FILE": table(
                spark,
                "Order_Number int, D_Level_Pointer string, C_Level_Pointer int, Lab_Ref_No string",
                (1, "r", 1, "lab"),
            ),
            "MICRO_RESULTS_FILE": table(
                spark,
                "ISRN string, Order_No int, WHO_COLLECTION_DATE_TIME timestamp_ntz,"
                " WHO_RECEIVE_DATE_TIME timestamp_ntz, specimen_site string",
                ("i", 1, datetime(2019, 12, 31), datetime(2020, 1, 1), "site"),
            ),
            "MICRO_TESTS": table(
                spark,
                "Micro_Tests int, Micro_Results_File string, Order_code string, Result_Expansion string",
                (1, "i", "oc", "result"),
                (2, "i", "oc", "other"),
            ),
            "MICRO_ORGANISMS": table(
                spark,
                "Micro_Tests int, Organism string, Organism_Code string, Quantifier int",
                (1, "one", "O1", 1),
                (1, "two", "O1", 2),
                (1, "wrong category", "X1", 1),
                (1, "no quantity", "O1", 9),
                (2, "wrong category", "X1", 1),
            ),
            "MF_ORGANISM_CODES": table(
                spark, "Organism_code string, Organism_category string", ("O1", "O"), ("X1", "X")
            ),
            "MF_QUANTITY_CODES": table(
                spark,
                "APEX_ID int, Quantity_Description string, Rec_as_Signif_Growth string",
                (1, "many", "Y"),
                (2, None, None),
            ),
        }
    )
    got = microbiology.build(catalog, PARAMS).select("organism_or_bug", "sensitivity")
    assert rows(got) == [("one", "many"), ("two", "result"), (None, "other")]
    found = microbiology.organisms_found(catalog).select("organism", "significant_growth")
    assert rows(found) == [("one", "Yes"), ("two", "No")]


def test_export_gate_and_cutoff(spark):
    episodes = table(
        spark,
        "uhl_system_number string, admission_date_time timestamp_ntz",
        ("A", datetime(2021, 6, 30)),
        ("b", datetime(2021, 6, 30, 10)),
        ("C", None),
    )
    eligible = eligible_patients(episodes, PARAMS)
    assert rows(eligible) == [("A",)]
    target = table(
        spark,
        "uhl_system_number string, order_id int, order_type string, order_description string,"
        " order_date_time timestamp_ntz",
        ("a ", 1, "t", "d", datetime(2021, 6, 30)),
        ("A", 2, "t", "d", datetime(2021, 6, 30, 0, 0, 1)),
        ("A", 3, "t", "d", None),
        ("B", 4, "t", "d", datetime(2021, 1, 1)),
        ("C", 5, "t", "d", datetime(2021, 1, 1)),
    )
    registry = table(
        spark, "participant_identifier string, uhl_system_number string", ("P1", "a"), ("P2", "B"), ("P3", "C")
    )
    got = export_rows(EXPORTS["orders"], target, registry, eligible, PARAMS)
    assert got.columns == ["subject", "order_id", "order_type", "order_description", "order_date_time", "brc_name"]
    assert rows(got.select("subject", "order_id", "brc_name")) == [("P1", 1, "Centre"), ("P1", 3, "Centre")]


def test_exports_follow_contracts():
    for export in EXPORTS.values():
        contract = CONTRACTS[export.target]
        computed = dict(export.computed)
        assert all(c in contract or c in computed for c in export.columns)
        assert all(d in contract for d in export.dates)
        assert "uhl_system_number" not in export.columns
    assert len(EXPORTS) == len(EXTRACTS) == 18


def test_movement_ties_and_last_event(spark):
    t1, t2, t3 = (datetime(2020, 1, d) for d in (1, 2, 3))
    schema = (
        "spell_id string, uhl_system_number string, transfer_datetime timestamp_ntz, transfer_type string,"
        " hospital string, ward_code string, ward_name string"
    )
    catalog = Catalog(
        {
            "transfer": table(
                spark,
                schema,
                ("s", "k", t1, "in", "h", "w", None),
                ("s", "k", t2, "a", "h", "w", None),
                ("s", "k", t2, "b", "h", "w", None),
                ("s", "k", t3, "out", "h", "w", None),
                ("alone", "k", t1, "in", "h", "w", None),
                ("late", "z", t1, "in", "h", "w", None),
                ("late", "z", t2, "out", "h", "w", None),
            ),
            "demographics": table(
                spark, "uhl_system_number string, participant_identifier string", ("K", "P"), ("z", "Q")
            ),
            "episode": table(
                spark,
                "uhl_system_number string, admission_datetime timestamp_ntz",
                ("k", t1),
                ("z", datetime(2021, 7, 1)),
            ),
        }
    )
    got = movement(catalog, PARAMS)
    assert rows(got.select("Subject", "start_type", "end_type", "ward_name")) == [
        ("P", "a", "out", ""),
        ("P", "b", "out", ""),
        ("P", "in", "a", ""),
        ("P", "in", "b", ""),
    ]


def test_views_are_published(spark):
    catalog = clinic.legacy(spark, "/root/testdata/sf0.001")
    assert set(publish_views(catalog, clinic.PARAMS)) == set(VIEWS) and len(VIEWS) == 15
    assert spark.sql("select count(*) from order_export").first()[0] > 0
    partial = Catalog({"demographics": catalog["demographics"], "episode": catalog["episode"]})
    assert set(publish_views(partial, clinic.PARAMS)) == {
        "demographics_filtered",
        "demographics_exports",
        "episode_export",
    }
