"""podelta: purchase-order follow-up jobs as Spark DataFrame plans.

Sub-packages:

* ``sources``   - table loading, stand-in input views, sinks.
* ``functions`` - ``Column -> Column`` expression builders (no Python UDFs).
* ``operators`` - ``DataFrame -> DataFrame`` jobs (views, rules, roll-ups,
  change sets, access, inspection, outbox).
* ``plans``     - end-to-end syncs and the query catalogue.
"""

from podelta.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
