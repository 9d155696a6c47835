"""DataFrame -> DataFrame steps: items (T1-T7), prices (F1, F2, P1, T9-T11), stores (T12), aggregates (A1-A3)."""
