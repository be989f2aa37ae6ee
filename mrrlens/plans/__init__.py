"""The layers: staging, calendar, dimensions, fact, reports, quality and the written marts."""
