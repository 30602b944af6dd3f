"""Versioned column contracts with report, raise, drop and quarantine modes."""

from tidewater.contracts.checks import Check
from tidewater.contracts.model import ContractModel, Field, typed
from tidewater.contracts.schema import Column, ColumnSpec, Contract, IndexSpec
from tidewater.contracts.validate import (ContractError, duplicate_reports, duplicate_rows, guarded_write, report,
                                          validate, validated_write)

__all__ = ["Check", "Column", "ColumnSpec", "Contract", "ContractError", "ContractModel", "Field",
           "IndexSpec", "duplicate_reports", "duplicate_rows", "guarded_write", "report", "typed", "validate", "validated_write"]
