"""Per-donor giving profiles for fundraising teams, as lazy Spark plans."""

from givingledger.params import ExportParams
from givingledger.plans.export import donor_export
from givingledger.sources.tables import DonorTables

__all__ = ["DonorTables", "ExportParams", "donor_export"]
