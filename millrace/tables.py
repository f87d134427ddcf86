"""Readers of the given Parquet tables and the schemas of files and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import tune

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Schemas are pinned as DDL, so no file is read twice to infer them.
EMPLOYEES = "EmployeeID int, Name string, Department string, Salary int, Experience int"
DEPARTMENTS = "DepartmentID int, DepartmentName string, Location string"
LOG_LINES = "timestamp string, level string, ip string, url string, status int, response_time int"
TRANSACTIONS_TEXT = ("transaction_id string, customer_id string, transaction_timestamp string, "
                     "amount string, category string, status string")
VISITS = "visit_id string, patient_id string, visit_date date, department string, doctor_id string"
PROCEDURES = "procedure_id string, visit_id string, procedure_name string, procedure_cost double"
INSURANCE = "patient_id string, insurance_provider string, coverage_percent double"
PAYMENTS = "payment_id string, visit_id string, payment_date date, payment_amount double, payment_method string"
BILLING_RECORD = (("visit_id", "string"), ("patient_id", "string"), ("department", "string"),
                  ("total_bill", "double"), ("insurance_covered", "double"), ("amount_paid", "double"),
                  ("outstanding_balance", "double"), ("billing_status", "string"))
TRIPS = ("trip_id string, driver_id string, rider_id string, pickup_zone_id int, dropoff_zone_id int, "
         "request_time timestamp, pickup_time timestamp, dropoff_time timestamp, distance_km double, "
         "fare decimal(10,2), status string, cancel_reason string, last_modified timestamp")
DRIVERS = ("driver_id string, name string, vehicle_type string, joined_date date, home_city string, "
           "home_zone_id int, rating decimal(3,2)")
RIDERS = "rider_id string, name string, joined_date date, home_city string, rating decimal(3,2)"
CITY_ZONES = ("zone_id int, zone_name string, borough string, service_zone string, "
              "centroid_lat double, centroid_lon double")
WEATHER_HOURLY = "hour_ts timestamp, temp_c double, rain_mm double"

# Stream messages.
CSV_TRANSACTIONS = "TransactionID string, EmployeeID string, Department string, Amount int"
CSV_PAYMENTS = ("payment_id string, visit_id string, payment_date string, payment_amount double, "
                "payment_method string")
DEPARTMENT_EVENTS = "transactionId string, employeeId string, department string, amount double"
CARD_TRANSACTIONS = ("transaction_id string, account_id string, amount double, merchant string, "
                     "country string, event_time string, is_international boolean")
CLICKSTREAM = "event_id string, user_id string, event_type string, page string, event_time timestamp"
BANK_TRANSACTIONS = ("transaction_id string, account_id string, customer_id string, "
                     "transaction_type string, amount int, city string, timestamp string")
VISIT_EVENTS = "visitor_id string, name string, page string, action string, timestamp string"
TRIP_REQUESTS = ("event_id string, event_time string, trip_id string, zone_id int, dropoff_zone_id int, "
                 "distance_km double, fare double, source string")
DRIVER_PINGS = ("event_id string, event_time string, driver_id string, zone_id int, lat double, "
                "lon double, status string, source string")
WEATHER = ("event_id string, event_time string, city string, temperature_c double, rain_mm_h double, "
           "precipitation_mm_h double, weather_code int, source string")
SURGE_OUTPUT = ("zone_id int, window_end string, demand int, supply int, on_trip int, ratio double, "
                "surge_multiplier double, rain_mm_h double, temp_c double, processed_at string, "
                "batch_id bigint")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with zone-less timestamps read as UTC."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    df = tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df
