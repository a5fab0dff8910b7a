"""The pipelines: order-side extracts, CRM chain, attribution, forecasts."""
