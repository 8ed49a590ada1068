"""Jobs and the runner."""

from keelson.plans.job import Job, RunMetrics, parse_properties, run_job
from keelson.plans.vehicle_job import VehicleJob
from keelson.plans.graph_job import PurchaseGraphJob

__all__ = ["Job", "PurchaseGraphJob", "RunMetrics", "VehicleJob", "parse_properties", "run_job"]
