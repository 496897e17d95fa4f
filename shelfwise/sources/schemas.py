"""Declared schemas of the six retail feeds.

Date columns arrive as text; the loaders turn them into epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

_TYPES = {"INT": IntegerType, "DOUBLE": DoubleType, "STRING": StringType, "BOOLEAN": BooleanType}


def _feed(columns: str) -> StructType:
    """Schema from ``name TYPE`` pairs."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]()) for name, kind in pairs])


# Column names, order and types of the delimited feeds.
CUSTOMER = _feed("""
    customerId INT, guid STRING, gender STRING, shippingCountry STRING,
    dateEntered STRING, dateModified STRING, yearOfBirth INT, premier INT
""")

PRODUCT = _feed("""
    productId INT, name STRING, brandName STRING, brandId INT, category STRING,
    departmentId INT, department STRING, divisionId INT, division STRING, season STRING,
    dateOnSite STRING, statusId INT, currentPrice DOUBLE, dateModified STRING, stockLevel INT,
    productType STRING, productTypeId INT, highLevelProductType STRING, highLevelProductTypeId INT,
    brandFamily STRING, isOwnBrand INT, isMaternity INT, isPolarizing STRING, isExcluded INT,
    isChristmas INT
""")

VARIANT = _feed("""
    productId INT, variantId INT, statusId INT, sizeId INT, sizeName STRING, colourCodeId STRING,
    colourName STRING, supplierColourName STRING, currentPrice DOUBLE, rrp DOUBLE, sku STRING,
    dateModified STRING, stockLevel INT
""")

RECEIPT = _feed("""
    customerId INT, gender STRING, productId INT, optionCode STRING, parentSkuCode STRING,
    childSkuCode STRING, receiptId INT, statusId INT, divisionId INT, signalDate INT,
    receiptSeasonDesc STRING, receiptStatusDesc STRING, brandDesc STRING, sizeId INT,
    sizeDesc STRING, colourId INT, colourDesc STRING, actualColourDesc STRING, itemQty INT,
    shippingCountryName STRING, shippingCountryCode STRING, discountSubGroup STRING,
    receiptStatusId INT, discountPercentage STRING, priceAtPurchase DOUBLE, paymentMethod STRING,
    shippingMethod STRING, shippingAmount STRING, isPremier BOOLEAN, dateEntered STRING,
    dateModified STRING
""")

RETURN = _feed("""
    customerId INT, gender STRING, returnId INT, returnItemId STRING, returnsDateKey STRING,
    receiptId INT, receiptItemId STRING, receiptDateKey STRING, optionCode STRING,
    parentSkuCode STRING, childSkuCode STRING, statusId STRING, divisionId INT, brandDesc STRING,
    sizeId STRING, sizeDesc STRING, colourId STRING, colourDesc STRING, actualColourDesc STRING,
    itemQty STRING, voidAction STRING, voidReason STRING, replacementReceiptId STRING,
    discountPercentage STRING, priceAtPurchase STRING, dateEntered STRING, dateModified STRING
""")

SIGNAL = _feed("""
    customerId INT, productId INT, variantId INT, divisionId INT, sourceId INT, itemQty INT,
    signalDate STRING, origin STRING, price DOUBLE, discountType STRING, useForRecs INT,
    dateModified STRING
""")
