"""Table schemas of every layer: the single place where names and types are stated."""

from __future__ import annotations

# Column names, types and widths of the published tables.

RAW_SALES = "CustomerId STRING, PurchaseDate STRING, Product STRING, Price STRING"

RAW_CUSTOMERS = (
    "ClientId STRING, FirstName STRING, LastName STRING, Email STRING, "
    "RegistrationDate STRING, State STRING"
)

RAW_PROFILES = (
    "email STRING, full_name STRING, state STRING, birth_date STRING, phone_number STRING"
)

SILVER_SALES = (
    "product_name STRING, client_id INT, price DECIMAL(12,2), purchase_date DATE"
)

SILVER_CUSTOMERS = (
    "client_id INT, first_name STRING, last_name STRING, email STRING, "
    "registration_date DATE, state STRING"
)

SILVER_PROFILES = (
    "email STRING, full_name STRING, birth_date DATE, age INT, "
    "state STRING, phone_number STRING"
)

GOLD_PROFILES = (
    "client_id INT, first_name VARCHAR(255), last_name VARCHAR(255), email VARCHAR(255), "
    "registration_date DATE, state VARCHAR(50), birth_date DATE, age INT, "
    "phone_number VARCHAR(50), updated_at TIMESTAMP"
)

GOLD_SALES = (
    "product_name VARCHAR(512), client_id INT, price DECIMAL(12,2), purchase_date DATE"
)

FOOD_DOCUMENT = (
    "foods ARRAY<STRUCT<fdcId: BIGINT, description: STRING, dataType: STRING, "
    "foodCategory: STRING, publishedDate: STRING, foodNutrients: "
    "ARRAY<STRUCT<nutrientName: STRING, value: DOUBLE, unitName: STRING>>>>"
)

# Width limits of the gold tables, for checking a frame before it is loaded.
GOLD_PROFILE_WIDTHS = {
    "first_name": 255,
    "last_name": 255,
    "email": 255,
    "state": 50,
    "phone_number": 50,
}
GOLD_SALES_WIDTHS = {"product_name": 512}
