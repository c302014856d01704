"""trafficlens: traffic quality and channel measurement on Spark.

Sessionise hit-level analytics events, attach request-risk and interaction
signals, label sessions Human / LLM_Scraper / Ad_Fraud, and report cleaned
sessions, bidding payloads, daily series, channel attribution and weekly
panels. Every operator is a DataFrame -> DataFrame function:

    from trafficlens.operators import sessionize, signals, classify, clean, channels
    sessions = sessionize.sessions_from_events(events, "2024-01-01", "2024-01-31")
    labelled = classify.classify_sessions(signals.enrich(sessions, measured))
    report = channels.channel_attribution(labelled)

``plans.pipeline.run`` composes the whole job; ``streaming.stream`` holds the
Structured Streaming forms.
"""

__version__ = "0.1.0"
