"""tidecast: one forecasting model per series, expressed as Spark jobs."""

from tidecast.spec import PanelSpec

__all__ = ["PanelSpec"]
