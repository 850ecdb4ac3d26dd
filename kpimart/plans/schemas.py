"""Declared mart schemas (the sinks' DDL)."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

REQUIRED = ("Load_Date", "Month_EndDate_Key")


def _f(name: str, t: DataType, nullable: bool = True) -> StructField:
    return StructField(name, t, nullable)


def _head() -> list[StructField]:
    return [_f("Load_Date", TimestampNTZType(), False), _f("Month_EndDate_Key", DateType(), False)]


def calendar_schema() -> StructType:
    return StructType(_head() + [
        _f("Month_EndDate_PreviousMonth", DateType()),
        _f("Month_EndDate_PreviousYearMonth", DateType()),
        _f("Fiscal_Year", IntegerType()),
        _f("Fiscal_Quarter", StringType()),
        _f("Month_ShortName", StringType()),
        _f("Display_Name", StringType()),
        _f("Indicator_Latest_Month", IntegerType()),
        _f("Indicator_Previous_Month", IntegerType()),
        _f("Indicator_Previous_Year_Month", IntegerType()),
    ])


def violations_schema(value: DataType | None = None) -> StructType:
    v = value or DecimalType(9, 2)
    return StructType(_head() + [
        _f("Section", StringType()), _f("Sub_Section", StringType()), _f("Violation_Type", StringType()),
        _f("Filter_1", StringType()), _f("Measure_Type", StringType()), _f("Measure_Values", v),
        _f("Ward", StringType()),
    ])


def permits_schema(value: DataType | None = None) -> StructType:
    v = value or DecimalType(9, 2)
    return StructType(_head() + [
        _f("Section", StringType()), _f("Sub_Section", StringType()), _f("Job_Class", StringType()),
        _f("Permit_Types", StringType()), _f("Measure_Type", StringType()), _f("Measure_Values", v),
        _f("Denominator", v),
    ])


def inspections_schema(value: DataType | None = None) -> StructType:
    v = value or DecimalType(9, 2)
    return StructType(_head() + [
        _f("Section", StringType()), _f("Sub_Section", StringType()),
        _f("Inspection_Cap_Type", StringType()), _f("Inspection_Type", StringType()),
        _f("Measure_Type", StringType()), _f("Measure_Values", v), _f("Denominator", v),
        _f("Ward", StringType()),
    ])


def decimal_type(text: str) -> DecimalType:
    """Parse ``decimal(p,s)``."""
    inner = text.strip().lower().removeprefix("decimal(").removesuffix(")")
    p, s = (int(x) for x in inner.split(","))
    return DecimalType(p, s)
